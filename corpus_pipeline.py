"""A training corpus from raw documents in five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.decontamination import decontaminate
from skyledger.llm.jaccard import deduplicate
from skyledger.llm.language import identify, in_a_language, learn_profiles, score_floors
from skyledger.llm.mixing import mix
from skyledger.llm.token_files import read_token_files, token_digests, write_token_files
from skyledger.llm.workers import with_bounded_batches, with_package
from skyledger.workspace import Workspace

#: id after each document in the token files
END_ID = 2


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language by rank-order profiles from all documents with a language. Documents in no known one go; the others carry the language found.

    Null texts, empty ones and those without a letter go; a null language teaches nothing. Repeated ids and rows are judged each; other columns are kept as they are.
    """
    found = identify(docs, learn_profiles(docs), into="_language")
    # a few numbers for each language; texts are looked at again rather than written once more
    floors, _ = Workspace(spark).materialize(score_floors(found.where("lang IS NOT NULL"), into="_language"), "floors")
    kept = in_a_language(found, floors, into="_language")
    return kept.select(*[F.col("_language.language").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8: the one of the least id. Texts without words are linked with nothing and stay, as do null ids;
    repeated rows are copies."""
    return deduplicate(docs, n=5, threshold=0.8)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item. Null and empty texts hold none and stay; of repeated rows all go or stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2 in turn and 150 % of all words, no source above twice its size. A null source is one of its own, the last; texts without words have no size, and their
    copies follow their source's rate; ids decide the last copy, so rows of one id fare alike."""
    return mix(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents; returns each document's place and digest as read from them. Null and empty texts have the end id only; a null id comes first, rows of one id
    by a hash of their text."""
    import public_tokenizers

    folder = Workspace(spark).root + "/tokens"
    manifest = write_token_files(docs, folder if "://" in folder else f"file://{folder}", public_tokenizers.path("word_bpe_49k.json"), end_id=END_ID)
    return token_digests(read_token_files(spark, manifest))


STAGES = [
    (name, with_bounded_batches(with_package(stage)))
    for name, stage in [("language", keep_languages), ("copies", drop_copies), ("benchmarks", drop_benchmarks), ("mix", mix_sources), ("tokens", write_tokens)]
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = work.materialize(docs, f"{k}-{name}")
    return docs


#: models, similarity joins and token files are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain versions
ORACLE_SQL = None
