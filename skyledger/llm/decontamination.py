"""Benchmark decontamination (operator 5).

Rare word n-grams of the test items are seeds. Where a document has one, the passage around it is aligned with the item by Smith-Waterman over words, which
scores copies with replaced, added and dropped words.

* Rare is what chance does not bring: the product of an n-gram's word frequencies in the whole corpus. An item copied into a third of all documents keeps its
  seeds; runs of function words are none, but for the rarer half of each item's n-grams, which always are.
* The items' n-grams and words go to the tasks as a filter of fixed size; exact joins follow.
* Words are runs of letters and digits in lower case, so other punctuation and case hide no copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.words import ALNUM, grams, hashed_words, key_filter, passes, signed, slices
from skyledger.llm.workers import tidy
from skyledger.workspace import Workspace

#: words in a seed
SEED = 3
#: a seed is rare when chance brings it to fewer documents of average length than one in so many
RARE = 10_000
#: points of the alignment
MATCH, MISMATCH, GAP = 2, -1, -1
#: least share of an item's full score
THRESHOLD = 0.5


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return hashed_words(pc.utf8_lower(texts.cast(pa.large_string())), ALNUM)


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and the first and last word (exclusive) of the passage. Ties go to the earliest end."""
    m, n = len(item), len(passage)
    slope = np.arange(n + 1) * -GAP
    table = np.zeros((m + 1, n + 1), np.int32)
    for i in range(1, m + 1):
        above = table[i - 1]
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(passage == item[i - 1], MATCH, MISMATCH))
        table[i] = np.maximum.accumulate(row + slope) - slope  # gaps along the passage
    best = int(table.max())
    if best <= 0:
        return 0, 0, 0
    j = end = int(np.flatnonzero((table == best).any(axis=0))[0])
    i = int(np.flatnonzero(table[:, end] == best)[0])
    while table[i, j]:
        here = table[i, j]
        if here == table[i - 1, j - 1] + (MATCH if passage[j - 1] == item[i - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif here == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, j, end


def _items(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item_id, text) once, without null texts."""
    return benchmark.select(F.col(f"`{id_column}`").cast("bigint").alias("item_id"), F.col(f"`{text_column}`").cast("string").alias("text")).where("text IS NOT NULL").distinct()


def _item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, bounds = _words(batch.column(1))
        for k, item in enumerate(batch.column(0).to_pylist()):
            own = words[bounds[k] : bounds[k + 1]]
            size = min(SEED, len(own))
            found, places = grams(own, np.array([0, len(own)]), size) if size else (own, np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict({
                "item_id": pa.array([item] * len(found), pa.int64()), "seed": signed(found), "place": places, "n_words": np.full(len(found), len(own)),
                "words": pa.array([signed(own[p : p + size]) for p in places], pa.list_(pa.int64())),
            })


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, bounds = _words(batch.column(1))
        yield pa.RecordBatch.from_pydict({"item_id": batch.column(0).cast(pa.int64()), "item_words": pa.array([signed(words[bounds[k] : bounds[k + 1]]) for k in range(len(batch))], pa.list_(pa.int64()))})


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text", item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """(doc_id, doc_key, item_id, score, start_word, end_word) of every copy of an item: the best alignment of a document with each item, if at least ``threshold``.

    The score is the alignment's share of the item's full score, 1 for an exact copy. Null and empty texts match nothing. ``doc_key`` is a hash of id and text, so
    equal rows share one result, and rows of one id but different texts have each their own. An item with fewer than three words is its own seed; items of equal id and different text are found each.
    Other columns are not read.
    """
    spark, work = docs.sparkSession, Workspace(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    texts = texts.withColumn("doc_key", F.xxhash64("doc_id", "text"))
    items, _ = work.materialize(_items(benchmark, item_id_column, item_text_column).withColumn("item", F.xxhash64("item_id", "text")), "items")
    own_grams = items.select("item", "text").mapInArrow(tidy(_item_grams), "item_id bigint, seed bigint, place bigint, n_words bigint, words array<bigint>").withColumnRenamed("item_id", "item")
    own_grams, _ = work.materialize(own_grams, "grams")
    seed_bits = spark.sparkContext.broadcast(key_filter(own_grams, "seed"))
    vocabulary = own_grams.select(F.explode("words").alias("word")).distinct()
    word_bits = spark.sparkContext.broadcast(key_filter(vocabulary, "word"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places of n-grams that may be seeds (with the document's key), counts of words that may be the items', and the number of words and documents."""
        counts, n_words, n_docs = {}, 0, 0
        for batch in batches:
            for part in slices(batch):
                words, bounds = _words(part.column(0))
                n_words, n_docs = n_words + len(words), n_docs + len(part)
                own, n = np.unique(words[passes(word_bits.value, words)], return_counts=True)
                for w, c in zip(own.tolist(), n.tolist()):
                    counts[w] = counts.get(w, 0) + c
                keys = part.column(1).to_numpy()
                for size in range(1, SEED + 1):
                    found, places = grams(words, bounds, size)
                    hit = np.flatnonzero(passes(seed_bits.value, found))
                    doc = np.searchsorted(bounds, places[hit], side="right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(keys[doc]), pa.array(signed(found[hit])), pa.array(places[hit] - bounds[doc])], ["doc_key", "hash", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(counts), pa.int64()), pa.array(np.array(list(counts), np.uint64).view(np.int64)), pa.array(list(counts.values()), pa.int64())], ["doc_key", "hash", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(2, pa.int64()), pa.nulls(2, pa.int64()), pa.array([n_words, -n_docs], pa.int64())], ["doc_key", "hash", "n"])

    scanned, _ = work.materialize(texts.select("text", "doc_key").mapInArrow(tidy(scan), "doc_key bigint, hash bigint, n bigint"), "scanned")
    totals = scanned.where("doc_key IS NULL AND hash IS NULL").agg(F.sum(F.expr("if(n > 0, n, 0)")).alias("words"), F.sum(F.expr("if(n < 0, -n, 0)")).alias("docs"))
    frequency = scanned.where("doc_key IS NULL AND hash IS NOT NULL").groupBy(F.col("hash").alias("word")).agg(F.sum("n").alias("n"))
    share = F.log(F.coalesce("n", F.lit(0)) + 0.5) - F.log(F.col("words") + 1.0)
    chance = own_grams.select("item", "seed", "place", "n_words", F.explode("words").alias("word")).join(frequency, "word", "left").crossJoin(F.broadcast(totals))  # one row
    chance = chance.groupBy("item", "seed", "place", "n_words").agg(F.sum(share).alias("_log"), F.first(F.log(F.col("words") + 1.0) - F.log(F.col("docs") + 1.0)).alias("_length"))
    place_in_item = F.percent_rank().over(Window.partitionBy("item").orderBy("_log"))
    rare = chance.withColumn("_rank", place_in_item).where((F.col("_log") + F.col("_length") < -F.log(F.lit(float(RARE)))) | (F.col("_rank") <= 0.5))
    seeds, _ = work.materialize(rare.select("item", "seed", "place", "n_words"), "seeds")

    hits = scanned.where("doc_key IS NOT NULL").select("doc_key", F.col("hash").alias("seed"), F.col("n").alias("at")).join(seeds, "seed")
    # where the item would begin, give or take half its length
    pairs = hits.groupBy("doc_key", "item", "n_words").agg(F.collect_set((F.col("at") - F.col("place")).cast("bigint")).alias("begins"))
    pairs, _ = work.materialize(pairs, "pairs")
    doc_bits = spark.sparkContext.broadcast(key_filter(pairs, "doc_key"))

    def doc_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(doc_bits.value, batch.column(1).to_numpy())))
            for part in slices(batch):
                words, bounds = _words(part.column(0))
                yield pa.RecordBatch.from_pydict({"doc_key": part.column(1), "doc_id": part.column(2), "doc_words": pa.array([signed(words[bounds[k] : bounds[k + 1]]) for k in range(len(part))], pa.list_(pa.int64()))})

    held = texts.select("text", "doc_key", "doc_id").mapInArrow(tidy(doc_words), "doc_key bigint, doc_id bigint, doc_words array<bigint>").dropDuplicates(["doc_key"])
    item_words = items.select("item", "text").mapInArrow(tidy(_item_words), "item_id bigint, item_words array<bigint>").withColumnRenamed("item_id", "item")
    least = threshold

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(len(batch)):
                own, item = (np.asarray(batch.column(k)[row].values) for k in (2, 4))
                slack, best = len(item) // 2 + 4, (0, 0, 0)
                low = high = None
                for begin in [*sorted(batch.column(3)[row].as_py()), None]:
                    if begin is not None and high is not None and begin - slack <= high:
                        high = begin + len(item) + slack
                        continue
                    if high is not None:
                        low = max(0, low)
                        points, start, end = align(own[low:high], item)
                        if points > best[0]:
                            best = (points, start + low, end + low)
                    if begin is not None:
                        low, high = begin - slack, begin + len(item) + slack
                if best[0] >= least * MATCH * len(item):
                    out.append((batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), batch.column(5)[row].as_py(), best[0] / (MATCH * len(item)), best[1], best[2]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "doc_key", "item", "score", "start_word", "end_word"])

    joined = pairs.join(held, "doc_key").join(item_words, "item").select("doc_id", "doc_key", "doc_words", "begins", "item_words", "item")
    found = joined.mapInArrow(tidy(score), "doc_id bigint, doc_key bigint, item bigint, score double, start_word bigint, end_word bigint")
    return found.join(items.select("item", "item_id"), "item").select("doc_id", "doc_key", "item_id", "score", "start_word", "end_word")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents without a copy of any item, all columns and repeated rows as they are."""
    found, _ = Workspace(docs.sparkSession).materialize(find_contamination(docs, benchmark, id_column=id_column, text_column=text_column, **options).select("doc_key").distinct(), "contaminated")
    key = F.xxhash64(F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text_column}`").cast("string"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), key.alias("_key"))
    return rows.join(found, F.col("_key") == F.col("doc_key"), "left_anti").select("_doc.*")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of a benchmark item in the documents."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return find_contamination(docs, benchmark).select("doc_id", "item_id", F.round("score", 6).alias("score"), "start_word", "end_word")
