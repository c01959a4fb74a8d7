"""Periodic runs of words: stretches that repeat a phrase over and over (operator 13).

A run is a stretch of words with smallest period q that is at least LEAST words and REPEATS periods long and cannot be extended. Two steps find
all of them, exactly:

* Frequency splitting. In a run every word occurs REPEATS times or more. A word that occurs less often within its segment is in no run there and
  splits it; what is shorter than LEAST goes. Smaller segments make more words rare, so this is repeated where something changed, until nothing does.
* Lag scan of the segments that survive. Lags are tried by octaves: for lags from w/2 (excluded) to w, windows of w words get numbers (those
  of twice the width are pairs of numbers), and only the lag at which a window comes next is scanned. A run with such a period holds two such windows at least, one
  period apart and no nearer, since a window of a whole period recurs only by whole periods. Neighbouring windows with one lag make up the run.

All texts of a slice go through both steps at once. Work is O(n log n) for each round, memory some 200 bytes for each word of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import once
from skyledger.llm.words import slices

#: least length of a run, in words and in periods
LEAST, REPEATS = 24, 3
#: bytes of text looked at together; a longer text is looked at alone
TOGETHER = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
FOUND = f"struct<n_words: bigint, runs: {RUNS}, collapsed: string>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_by_frequency(ids: np.ndarray, part: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Places, in order, that are left when no word occurs less than ``repeats`` times in its segment and none is shorter than ``least``.

    ``part`` is the number of the text of each place, from 0. A gap in the places parts two segments; texts are parted by a place of a word of their own.
    """
    place, done = np.arange(len(ids)), []
    span = int(ids.max(initial=0)) + 1
    while len(place):
        _, word, count = np.unique(part * span + ids[place], return_inverse=True, return_counts=True)
        often = count[word] >= repeats
        changed = np.zeros(part[-1] + 1, bool)
        changed[part[~often]] = True
        again = changed[part]
        done.append(place[~again])
        place, part = place[again & often], part[again & often]
        if len(place):
            begins = np.append(True, (np.diff(place) > 1) | (np.diff(part) > 0))
            part = np.cumsum(begins) - 1
            long = np.bincount(part)[part] >= least
            place, part = place[long], part[long]
            part = np.cumsum(np.append(False, np.diff(part) > 0)) if len(part) else part
    return np.sort(np.concatenate(done)) if done else place


def scan_lags(ids: np.ndarray, longest: int, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Runs (start, length, period) among words; no run is longer than ``longest``."""
    found, key, w = [], ids, 1
    while w // 2 < longest // repeats:
        order = np.argsort(key, kind="stable")
        again = key[order[1:]] == key[order[:-1]]
        if not again.any():
            break
        lag = np.zeros(len(key), np.int64)
        lag[order[:-1][again]] = np.diff(order)[again]
        at = np.flatnonzero((lag > w // 2) & (lag <= w))
        if len(at):
            cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(lag[at]) != 0))
            first, last = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
            runs = np.stack([first, last - first + w + lag[first], lag[first]], axis=1)
            found.append(runs[runs[:, 1] >= np.maximum(least, repeats * runs[:, 2])])
        if len(key) <= w:
            break
        key = np.unique(key[:-w] * (int(key.max()) + 1) + key[w:], return_inverse=True)[1]
        w *= 2
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each text, given as its words, the runs (start, length, period) by start and period."""
    known: dict[bytes, int] = {}
    ids = np.array([i for words in texts for i in (0, *[known.setdefault(w, len(known) + 1) for w in words])], np.int64)
    sizes = np.array([len(words) + 1 for words in texts], np.int64)
    offsets = np.cumsum(sizes) - sizes
    place = split_by_frequency(ids, np.repeat(np.arange(len(texts)), sizes))
    runs = np.zeros((0, 3), np.int64)
    if len(place):
        gaps = np.flatnonzero(np.diff(place) > 1) + 1
        # a word of its own between two segments keeps windows from crossing
        held = np.insert(ids[place], gaps, len(known) + 1 + np.arange(len(gaps)))
        places = np.insert(place, gaps, -1)
        runs = scan_lags(held, int(np.diff(np.concatenate([[0], gaps, [len(place)]])).max()))
        runs[:, 0] = places[runs[:, 0]]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    text = np.searchsorted(offsets, runs[:, 0], "right") - 1
    runs[:, 0] -= offsets[text] + 1
    return np.split(runs, np.searchsorted(text, np.arange(1, len(texts))))


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without what a run repeats, joined by one blank."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)])


def find_periodic_runs(docs: DataFrame, text_column: str = "text", into: str = "periodic") -> DataFrame:
    """Every row with a struct column ``into``: n_words, runs (start, length and period in words, by start and period) and collapsed, the text
    without the words that a run adds after its first period.

    Words are what U+0020 and U+0009 to U+000D part, compared as they are. A null or empty text has no words, no runs and an empty collapsed text.
    Runs may overlap; a word goes if any run repeats it. Equal texts have equal results, repeated rows stay. A column of the name ``into`` is
    replaced, all others are kept.
    """
    kept = [c for c in docs.columns if c != into]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                # bytes.split parts at these six characters exactly
                texts = [t.split() for t in part.column(1).cast(pa.binary()).to_pylist()]
                each = runs_of(texts)
                flat = np.concatenate(each) if each else np.zeros((0, 3), np.int64)
                ends = np.cumsum([0, *map(len, each)]).astype(np.int32)
                runs = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN)))
                left = pa.array([collapse(w, r) for w, r in zip(texts, each)], pa.binary()).cast(pa.string())
                result = pa.StructArray.from_arrays([pa.array([len(t) for t in texts], pa.int64()), runs, left], ["n_words", "runs", "collapsed"])
                yield pa.RecordBatch.from_arrays([part.column(0), result], ["row", "found"])

    schema = rows.select("row", F.lit(None).cast(FOUND).alias("found")).schema
    out = rows.mapInArrow(find, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in kept], F.col("found").alias(into))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten, chosen by its id, ends in a repeated phrase; a null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, g).alias("g"))
    rows = once(rows, F.when(F.col("g").isNotNull(), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))), "words")
    n = F.size("words")
    a = F.col("g") % n
    rows = rows.withColumn("a", F.when(n > 0, a).cast("int")).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which ends in a repeated phrase: how many, the one of the greatest exponent, and digests of all and of the rest."""
    found = find_periodic_runs(with_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
    runs = F.col("periodic.runs")

    def better(best: Column, run: Column) -> Column:
        # runs come by start and period, so of equal exponents the first counts; both products are below 2^63
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    best = F.aggregate(runs, F.lit(None).cast(RUNS[6:-1]), better)
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select(
        "doc_id", F.size(runs).cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"),
    )
    return rows.select(
        "doc_id", "n_runs", *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
