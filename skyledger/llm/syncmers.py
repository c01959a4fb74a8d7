"""Document fingerprints of closed syncmers (operator 2); DataFrame functions only.

A k-mer of k words is chosen when the least of the hashes of its inner s-word runs is at its first or last place. That depends on the k-mer alone and not on
what surrounds it, so an unchanged passage keeps its anchors wherever it moves, and anchors of two documents can be matched by position.

Words are runs without blanks, in lower case. Characters of scripts that are written without blanks are words of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import once
from skyledger.operators.order import number_rows
from skyledger.workspace import Workspace

#: words in a k-mer and in its inner runs
K, S = 5, 2

# Fixed ranges of code points: Thai and Lao, Myanmar, Khmer, East Asian ideographs and syllables, their compatibility forms, and the ideographic planes.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003fffd"
WORD = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def with_anchors(docs: DataFrame, text: Column, into: str, k: int = K, s: int = S) -> DataFrame:
    """Add ``into``, the closed syncmers of a text in order: an array of (at, hash), where ``at`` is the place of the k-mer's first word.

    A text with fewer than k words has one anchor, of all its words; one with k-mers but no closed syncmer has the k-mer of least hash. A null or empty text, or one of blanks, has none.
    Each expression is evaluated once for a row: words, run hashes and anchors are columns of their own, made by one generator each.
    """
    width = k - s + 1
    words, runs = F.col("_words"), F.col("_runs")
    docs = once(docs, _words(text), "_words")
    run = F.transform(F.sequence(F.lit(0), F.size(words) - s), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(s)]))
    docs = once(docs, F.when(F.size(words) >= k, run).otherwise(F.array().cast("array<bigint>")), "_runs")

    def closed(i: Column) -> Column:
        least = F.least(*[F.get(runs, i + j) for j in range(width)]) if width > 1 else F.get(runs, i)
        return (F.get(runs, i) == least) | (F.get(runs, i + width - 1) == least)

    def anchor(i: Column) -> Column:
        return F.struct(i.alias("at"), F.xxhash64(*[F.get(runs, i + j) for j in range(width)]).alias("hash"))

    places = F.sequence(F.lit(0), F.size(runs) - width)
    docs = once(docs, F.when(F.size(runs) > 0, F.filter(places, closed)).otherwise(F.array().cast("array<int>")), "_chosen")
    whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(F.concat_ws("\n", words)).alias("hash")))
    least = F.slice(F.array_sort(F.transform(places, anchor), lambda x, y: F.when(x["hash"] < y["hash"], -1).when(x["hash"] > y["hash"], 1).otherwise(x["at"] - y["at"])), 1, 1)
    alone = F.when(F.size(runs) > 0, least).when(F.size(words) > 0, whole).otherwise(F.array().cast("array<struct<at:int,hash:bigint>>"))
    docs = docs.withColumn(into, F.when(F.size("_chosen") > 0, F.transform("_chosen", anchor)).otherwise(alone))
    return docs.drop("_words", "_runs", "_chosen")


def marks(anchors: Column) -> Column:
    """The set of an anchor array, the upper 32 bits of each hash in ascending order; what fingerprints are compared by."""
    return F.array_sort(F.array_distinct(F.transform(anchors, lambda a: F.shiftright(a["hash"], 32).cast("int"))))


def fingerprint(marks_: Column) -> Column:
    """A set of marks as text: eight hexadecimal digits each, in ascending order."""
    return F.array_join(F.transform(marks_, lambda m: F.lower(F.lpad(F.hex(m.cast("bigint").bitwiseAND(0xFFFFFFFF)), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def closed_syncmers(docs: DataFrame, k: int = K, s: int = S, text_column: str = "text", into: str = "anchors") -> DataFrame:
    """Every document with its anchors in column ``into`` (see ``with_anchors``). A column of that name is replaced; all others and repeated rows are kept."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != into]).alias("_doc"), F.col(f"`{text_column}`").cast("string").alias("_text"))
    return with_anchors(rows, F.col("_text"), "_anchors", k, s).select("_doc.*", F.col("_anchors").alias(into))


def match_anchors(a: Column, b: Column) -> Column:
    """Positional matches of two anchor arrays: (at_a, at_b) of every anchor of ``a`` with those of ``b`` that have its hash."""
    return F.flatten(F.transform(a, lambda x: F.transform(F.filter(b, lambda y: y["hash"] == x["hash"]), lambda y: F.struct(x["at"].alias("at_a"), y["at"].alias("at_b")))))


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter is the beginning of the next document.

    Ids are put in order in a narrow table. Texts are shuffled once, by id, and used from there twice: a document meets the document before it in the order, to which
    its beginning and its marks are sent, and then what the next one has sent. Marks are worked out on both sides, as that costs less than to shuffle them with the texts.
    Rows that share an id are in the order of a hash of their text, equal rows are one document, and a null id comes first.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64("text", F.col("doc_id").isNull()))
    keys = docs.select("id", "tie", "doc_id", F.length("text").cast("bigint").alias("n_chars")).dropDuplicates(["id", "tie"])
    ordered, seen = Workspace(spark).materialize(number_rows(keys, ["id", "tie"]), "ordered")
    after = (F.col("row_no") + 1) % F.lit(max(1, seen["n_rows"]))
    here = ordered.select(F.col("id").alias("to_id"), F.col("tie").alias("to_tie"), "doc_id", F.floor(F.col("n_chars") / 4).alias("taken"), after.alias("row_no"))
    turns = here.join(ordered.drop("n_chars", "doc_id"), "row_no").drop("row_no")

    texts = docs.select("id", "tie", "text")
    sent = texts.join(turns, ["id", "tie"])
    sent = once(with_anchors(sent, F.col("text"), "anchors"), marks(F.col("anchors")), "next_marks").drop("anchors")
    sent = sent.select(F.col("to_id").alias("id"), F.col("to_tie").alias("tie"), "doc_id", F.expr("substring(text, 1, cast(taken AS int))").alias("beginning"), "next_marks")
    # equal rows send the same
    sent = sent.groupBy("id", "tie").agg(*[F.first(c).alias(c) for c in ("doc_id", "beginning", "next_marks")])
    both = texts.join(sent, ["id", "tie"])
    both = once(with_anchors(both, F.col("text"), "anchors"), marks(F.col("anchors")), "marks").drop("anchors")
    kept = F.expr("substring(text, 1, cast(length(text) - floor(length(text) / 4) AS int))")
    both = once(both, F.concat(kept, "beginning"), "edited")
    both = once(with_anchors(both, F.col("edited"), "anchors"), marks(F.col("anchors")), "edited_marks")
    return both.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("marks")).alias("fingerprint"),
        fingerprint(F.col("edited_marks")).alias("edited_fingerprint"), likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"), likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
