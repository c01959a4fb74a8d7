"""Language identification by rank-order profiles of character n-grams (operator 7).

A profile lists the most frequent n-grams of one to three characters by frequency. A text is compared with the profile of each language by the
out-of-place distance: for each n-gram of the text's own profile, how far its rank is from its rank in the language, or PROFILE when the
language's profile lacks it. The least distance wins.

N-grams are runs of letters (and marks) in lower case; a word's edges count as a blank. Three code points fit one 64-bit key exactly.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.words import slices
from skyledger.llm.workers import drop_caches, tidy

#: n-grams in a profile
PROFILE = 400
#: bound of the model that goes to every task: languages times PROFILE n-grams. More languages are an error.
MOST_LANGUAGES = 1000
#: code points counted at a time
PIECE = 1 << 18
#: bytes of text counted together; a byte takes up to 40 bytes of a worker's memory
SLICE = 1 << 20
BLANK = 32
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter or mark, else a blank."""
    table = np.full(0x110000, BLANK, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if unicodedata.category(char)[0] in "LM":
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


@cache
def _is_letter() -> np.ndarray:
    return np.array([unicodedata.category(chr(code))[0] == "L" for code in range(0x110000)])


def code_points(text: str) -> np.ndarray:
    """Letters of a text with a blank before, between and after its words; empty without a letter."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not _is_letter()[raw].any():
        return np.zeros(0, np.uint64)
    codes = np.concatenate([[BLANK], _letters()[raw], [BLANK]]).astype(np.uint64)
    blank = codes == BLANK
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def count_grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in ascending order with their counts."""
    parts = []
    for at in range(0, len(codes), PIECE):
        a = codes[at : at + PIECE + 2]
        own = min(PIECE, len(codes) - at)
        b, c = a[1:], a[2:]
        one = a[:own][a[:own] != BLANK]
        two = ((a[:-1] << np.uint64(21)) | b)[:own]
        three = ((a[:-2] << np.uint64(42)) | (b[:-1] << np.uint64(21)) | c)[:own]
        three = three[(b[:-1] != BLANK)[:own]]
        parts.append(np.unique(np.concatenate([one, two, three]), return_counts=True))
    return _merge(parts) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def profile(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams by frequency, ties by code points."""
    return keys[np.argsort(-counts, kind="stable")[:PROFILE]]


class Model:
    """Ranks of the n-grams of all profiles."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.languages = sorted(profiles)
        self.keys = np.unique(np.array([k for p in profiles.values() for k in p], np.uint64))
        self.ranks = np.full((len(profiles), len(self.keys) + 1), -1, np.int32)
        for row, language in enumerate(self.languages):
            self.ranks[row, np.searchsorted(self.keys, np.array(profiles[language], np.uint64))] = np.arange(len(profiles[language]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score, 1 - distance / greatest distance; of equal distances the first language by code point."""
        codes = code_points(text) if text else np.zeros(0, np.uint64)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        own = profile(*count_grams(codes))
        at = np.searchsorted(self.keys, own)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != own] = len(self.keys)
        ranks = self.ranks[:, at]
        away = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(away))
        return self.languages[best], float(1 - away[best] / (PROFILE * len(own)))


def learn_profiles(docs: DataFrame, learn: Column | None = None, text_column: str = "text", lang_column: str = "lang") -> dict[str, list[int]]:
    """The profile of each language from all documents that have one (of those for which ``learn`` is true).

    Every n-gram of every such text counts. Counts are summed in each task, then over all tasks; the PROFILE most frequent n-grams of each
    language reach the driver. Null texts and languages teach nothing.
    """
    rows = docs.select(F.col(f"`{text_column}`").cast("string").alias("text"), F.col(f"`{lang_column}`").cast("string").alias("lang"), (F.lit(True) if learn is None else learn).alias("learn"))
    rows = rows.where("learn AND lang IS NOT NULL AND text IS NOT NULL").drop("learn")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                texts, languages = part.column(0).to_pylist(), part.column(1).to_pylist()
                by_language: dict[str, list[np.ndarray]] = {}
                for text, language in zip(texts, languages):
                    by_language.setdefault(language, []).append(code_points(text)[1:])  # the blank at the end parts the texts
                for language, codes in by_language.items():
                    counted = count_grams(np.concatenate([np.array([BLANK], np.uint64), *codes]))
                    found[language] = _merge([found[language], counted]) if language in found else counted
        for language, (keys, counts) in found.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([language] * len(keys), pa.string()), "gram": keys.view(np.int64), "n": counts.astype(np.int64)})

    counted = rows.mapInArrow(tidy(count), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= PROFILE).limit(MOST_LANGUAGES * PROFILE + 1).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    if len(top) > MOST_LANGUAGES * PROFILE or len(profiles) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in column {lang_column}")
    return profiles


def identify(docs: DataFrame, profiles: dict[str, list[int]], text_column: str = "text", into: str = "language") -> DataFrame:
    """Every document with a struct column ``into`` of language and score, from its text alone.

    A text that is null, empty or without a letter has language ``und`` and score 0; so has any text when there are no profiles. Equal texts have
    equal results. A column of the name ``into`` is replaced, all others are kept.
    """
    model = Model(profiles)

    # a filter on the result must not be moved below and predict again, in a second worker of the task
    @F.pandas_udf("struct<language: string, score: double>")
    def predict(texts):
        import pandas as pd

        drop_caches()
        return pd.DataFrame([model.predict(t) for t in texts], columns=["language", "score"])

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != into], predict.asNondeterministic()(F.col(f"`{text_column}`").cast("string")).alias(into))


#: share of a language's own texts of some length whose scores are below the mark, and the part of that mark that a text must exceed
LOW_SHARE, MARGIN = 0.01, 0.5


def text_size(text: Column) -> Column:
    """Length class of a text: texts of one class are at most twice as long as each other."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def score_floors(found: DataFrame, lang_column: str = "lang", text_column: str = "text", into: str = "language") -> DataFrame:
    """(language, size, floor) of documents with the result of ``identify``: what a text must exceed to be in a language.

    How well a text fits its own language depends on its length and on how many characters the script has, so it is measured on all documents whose given
    language is the one found: MARGIN of the score that LOW_SHARE of them don't reach. At most 32 rows for each of MOST_LANGUAGES languages.
    """
    own = found.where(F.col(f"`{lang_column}`").cast("string") == F.col(f"`{into}`.language"))
    rows = own.groupBy(F.col(f"`{into}`.language").alias("language"), text_size(F.col(f"`{text_column}`").cast("string")).alias("size"))
    return rows.agg((F.percentile_approx(F.col(f"`{into}`.score"), LOW_SHARE, 1000) * MARGIN).alias("floor"))


def in_a_language(found: DataFrame, floors: DataFrame, text_column: str = "text", into: str = "language") -> DataFrame:
    """The documents that are in the language found: their score is above the floor of language and length, or above 0 where no such text has taught one. Texts of no language go."""
    marks = floors.withColumnsRenamed({"language": "_floor_of", "size": "_floor_size", "floor": "_floor"})
    size = text_size(F.col(f"`{text_column}`").cast("string"))
    held = found.join(F.broadcast(marks), (F.col(f"`{into}`.language") == F.col("_floor_of")) & (size == F.col("_floor_size")), "left")
    kept = held.where((F.col(f"`{into}`.language") != UNKNOWN) & (F.col(f"`{into}`.score") > F.coalesce("_floor", F.lit(0.0))))
    return kept.drop("_floor_of", "_floor_size", "_floor")


def fold(doc_id: Column, n: int) -> Column:
    """CRC-32 of an id as text, modulo n; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % n, F.lit(0).cast("bigint"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by profiles from two thirds of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = fold(F.col("doc_id"), 3) == 1
    profiles = learn_profiles(docs, ~held_out)
    found = identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), F.col("language.language").alias("lang_pred"), F.col("language.score").alias("score"))
