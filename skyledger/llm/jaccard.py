"""Join of documents whose word n-gram sets are alike (operator 3).

Rare-first prefix filtering. All n-grams have one order, rarest first. Two sets that reach the Jaccard threshold share n-grams among the first
few of each, so only those are joined. With some more of them a pair must share several, which chance seldom brings about (adaptive prefixes).
Length, positional and suffix filters drop pairs, and each pair left is verified once on whole sets.

* Documents with equal sets are one class; the join works on classes.
* The order is used twice. First, rarity is estimated over all documents in a count table of fixed size (COUNTERS cells that n-grams share); that finds the classes
  that can have a partner at all. Then rarity is counted exactly among those. So n-grams that no other class has come first, and say how much a class can share at most.
* A class identity and an n-gram are 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.columns import let
from skyledger.llm.components import connected_components
from skyledger.llm.words import grams, hashed_words, key_filter, mix, passes, signed, slices
from skyledger.llm.workers import tidy
from skyledger.workspace import Workspace

#: cells of the rarity table: 16 MB however large the corpus is
COUNTERS = 1 << 22
#: cells of it that travel as one row
BLOCK = 1 << 14
#: one n-gram more in the prefixes, and in common, for each so many of a set
SPARE = 16
#: ranges of the n-gram space that the suffix filter compares
RANGES = 16
#: classes a task remembers to have sent
REMEMBERED = 200_000

_CELL_BITS = int(math.log2(COUNTERS))


def sets_of(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text in ascending order of hash; the whole sequence where it has fewer words."""
    words, bounds = hashed_words(texts)
    found, places = grams(words, bounds, n)
    cuts = np.searchsorted(places, bounds)
    for k in range(len(bounds) - 1):
        if cuts[k] < cuts[k + 1]:
            yield np.unique(found[cuts[k] : cuts[k + 1]])
        elif bounds[k] < bounds[k + 1]:
            short = words[bounds[k] : bounds[k + 1]]
            yield grams(short, np.array([0, len(short)]), len(short))[0]
        else:
            yield np.zeros(0, np.uint64)


def class_of(grams_: np.ndarray) -> np.uint64:
    """Identity of a set."""
    total, twist = grams_.sum(), np.bitwise_xor.reduce(grams_)
    return mix(np.array([total], np.uint64) + mix(np.array([twist ^ np.uint64(len(grams_))], np.uint64)))[0]


def in_common(size: int, threshold: Fraction) -> int:
    """How many n-grams of their prefixes two sets that are alike must share, by the smaller one's size. Prefixes are longer by that much."""
    return min(1 + size // SPARE, math.ceil(threshold * size))


def prefix_size(size: int, threshold: Fraction) -> int:
    """How many of its rarest n-grams a set must offer: those it may lack, and those it must have in common."""
    return size - math.ceil(threshold * size) + in_common(size, threshold)


def _row_key(id_column: str, text_column: str) -> list[Column]:
    """What tells rows apart that are not equal: the id and a hash of the text."""
    return [F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.xxhash64(F.col(f"`{text_column}`").cast("string")).alias("text_hash")]


def rarity(texts: DataFrame, n: int) -> np.ndarray:
    """How many documents have n-grams in each cell, over all documents. Tasks send rows of BLOCK cells; the driver gets COUNTERS cells in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in slices(batch):
                for own in sets_of(part.column(1), n):
                    np.add.at(cells, (own >> np.uint64(64 - _CELL_BITS)).astype(np.int64), 1)
        blocks = cells.reshape(-1, BLOCK)
        for k in np.flatnonzero(blocks.any(axis=1)):
            narrow = np.min_scalar_type(blocks[k].max()).newbyteorder("<")
            yield pa.RecordBatch.from_pydict({"block": [int(k)], "cells": pa.array([blocks[k].astype(narrow).tobytes()], pa.binary())})

    def add(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in blocks:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[block] = sums.get(block, np.zeros(BLOCK, np.uint64)) + np.frombuffer(cells, f"<u{len(cells) // BLOCK}")
        for block, cells in sums.items():
            yield pa.RecordBatch.from_pydict({"block": [block], "cells": pa.array([np.minimum(cells, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())})

    schema = "block bigint, cells binary"
    rows = texts.mapInArrow(tidy(count), schema).repartition(F.col("block")).mapInArrow(tidy(add), schema).collect()
    out = np.zeros((COUNTERS // BLOCK, BLOCK), np.uint32)
    for row in rows:
        out[row["block"]] = np.frombuffer(bytes(row["cells"]), "<u4")
    return out.reshape(-1)


def _rows(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names)


class Join:
    """One join over one table of documents; the steps are written tables."""

    def __init__(self, docs: DataFrame, n: int, threshold: float, id_column: str, text_column: str):
        self.spark, self.n = docs.sparkSession, n
        self.threshold = Fraction(str(threshold))
        doc_id, text_hash = _row_key(id_column, text_column)
        self.texts = docs.select(doc_id, F.col(f"`{text_column}`").cast("string").alias("text"), text_hash)
        self.work = Workspace(self.spark)
        self._members()

    def _members(self) -> None:
        """One pass writes each document's class and size, another the rarest n-grams of each class."""
        n, threshold = self.n, self.threshold
        counts = self.spark.sparkContext.broadcast(rarity(self.texts, n))

        def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    sets = list(sets_of(part.column(1), n))
                    ids = [int(class_of(s).view(np.int64)) if len(s) else None for s in sets]
                    yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "text_hash": part.column(2), "cls": pa.array(ids, pa.int64()), "size": pa.array([len(s) for s in sets], pa.int64())})

        def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: set[int] = set()
            for batch in batches:
                for part in slices(batch):
                    out = []
                    for own in sets_of(part.column(1), n):
                        cls = int(class_of(own).view(np.int64)) if len(own) else None
                        if cls is None or cls in known:  # equal sets of one task; others are dropped after the shuffle
                            continue
                        known.add(cls)
                        if len(known) > REMEMBERED:
                            known.clear()
                        rare = np.lexsort((own, counts.value[(own >> np.uint64(64 - _CELL_BITS)).astype(np.int64)]))
                        first = own[rare[: prefix_size(len(own), threshold)]]
                        out.append((signed(first), np.full(len(first), cls), np.full(len(first), len(own), np.int32)))
                    if out:
                        yield _rows(out, ["gram", "cls", "size"])

        self.docs, _ = self.work.materialize(self.texts.mapInArrow(tidy(classes), "doc_id bigint, text_hash bigint, cls bigint, size bigint"), "classes")
        prefix = self.texts.mapInArrow(tidy(prefixes), "gram bigint, cls bigint, size int").repartition("gram").groupBy("gram", "cls").agg(F.first("size").alias("size"))
        by_class = Window.partitionBy("gram").orderBy("cls")
        shared = prefix.select("cls", "size", F.lag("cls").over(by_class).alias("_one"), F.lead("cls").over(by_class).alias("_two")).where("_one IS NOT NULL OR _two IS NOT NULL")
        p, q = threshold.numerator, threshold.denominator
        able = shared.groupBy("cls", "size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= self._common(F.ceil(F.col("size") * F.lit(p) / F.lit(q))))
        able, _ = self.work.materialize(able.select("cls", F.col("size").cast("bigint").alias("size")), "able")
        counts.unpersist()
        self.sets = self._sets_of(able)
        self.shared = self._exact_prefixes()

    def _sets_of(self, able: DataFrame) -> DataFrame:
        """(cls, size, grams, ranges) of these classes, from one more pass over the texts that passes over all others."""
        n = self.n
        bits = self.spark.sparkContext.broadcast(key_filter(able, "cls"))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: set[int] = set()
            for batch in batches:
                for part in slices(batch):
                    found = [(int(class_of(s).view(np.int64)), s) for s in sets_of(part.column(1), n) if len(s)]
                    if not found:
                        continue
                    kept = passes(bits.value, np.array([c for c, _ in found], np.int64))
                    own = {c: s for (c, s), keep in zip(found, kept) if keep and c not in known}
                    known.update(own)
                    if len(known) > REMEMBERED:
                        known.clear()
                    ranges = [np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=RANGES) for s in own.values()]
                    yield pa.RecordBatch.from_pydict({
                        "cls": pa.array(list(own), pa.int64()), "grams": pa.array([signed(s) for s in own.values()], pa.list_(pa.int64())), "ranges": pa.array(ranges, pa.list_(pa.int64())),
                    })

        several = self.texts.mapInArrow(tidy(sets), "cls bigint, grams array<bigint>, ranges array<bigint>").join(able, "cls").dropDuplicates(["cls"])
        written, _ = self.work.materialize(several.select("cls", "size", "grams", "ranges"), "sets")
        bits.unpersist()
        return written

    def _exact_prefixes(self) -> DataFrame:
        """(gram, cls, size, able, place) of the prefixes by exact rarity, where another class has the n-gram in its prefix too, with the first class of the n-gram and the one before.

        ``place`` is the n-gram's place in its set, where those that no other class has come first; ``able`` is how many n-grams others have at all. A class that is not
        able to share as many as its smallest partner would need has no partner. The first class of an n-gram is that with the least place: the one with the fewest rarer n-grams.
        """
        p, q = self.threshold.numerator, self.threshold.denominator
        rows = self.sets.select("cls", "size", F.explode("grams").alias("gram"))
        often = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        mine = Window.partitionBy("cls")
        rank = F.row_number().over(mine.orderBy("n", "gram"))
        placed = rows.join(often, "gram").select("gram", "cls", "size", F.count(F.lit(1)).over(mine).alias("able"), rank.alias("_rank"))
        placed = placed.withColumn("place", F.col("size") - F.col("able") + F.col("_rank") - 1).drop("_rank")
        least = F.ceil(F.col("size") * F.lit(p) / F.lit(q))
        placed = placed.where((F.col("able") >= least) & (F.col("place") < F.col("size") - least + self._common(F.col("size"))))
        by_place = Window.partitionBy("gram").orderBy("place", "size", "cls")
        before = [F.lag(c).over(by_place).alias(f"{c}_before") for c in ("cls", "size", "able")]
        pivot = F.first(F.struct("cls", "size", "able")).over(by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("pivot")
        shared = placed.select("*", pivot, *before, F.lead("cls").over(by_place).alias("_after")).where("cls_before IS NOT NULL OR _after IS NOT NULL").drop("_after")
        return self.work.materialize(shared, "shared")[0]

    def _may_be_alike(self, a: str, b: str):
        """Length filter."""
        p, q = self.threshold.numerator, self.threshold.denominator
        return (F.col(a) * q >= F.col(b) * p) & (F.col(b) * q >= F.col(a) * p)

    def _enough(self, overlap, a: str, b: str):
        """Whether an overlap of sets of these sizes reaches the threshold: overlap * q >= p * union, in integers."""
        p, q = self.threshold.numerator, self.threshold.denominator
        return overlap * q >= (F.col(a) + F.col(b) - overlap) * p

    def _able(self, a: str, b: str, able_a: str, able_b: str):
        """Whether sets of sizes ``a`` and ``b`` are able to share enough."""
        p, q = self.threshold.numerator, self.threshold.denominator
        return F.least(able_a, able_b) * (p + q) >= (F.col(a) + F.col(b)) * p

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of the pairs (a, b, size_a, size_b), those that are links, with their overlap. Whole sets; the suffix filter first."""
        left = self.sets.select(F.col("cls").alias("a"), F.col("grams").alias("grams_a"), F.col("ranges").alias("ranges_a"))
        right = self.sets.select(F.col("cls").alias("b"), F.col("grams").alias("grams_b"), F.col("ranges").alias("ranges_b"))
        both = pairs.join(left, "a").join(right, "b")
        least = F.aggregate(F.zip_with("ranges_a", "ranges_b", lambda x, y: F.least(x, y)), F.lit(0).cast("bigint"), lambda s, x: s + x)
        both = both.where(self._enough(least, "size_a", "size_b"))
        overlap = F.size(F.array_intersect("grams_a", "grams_b")).cast("bigint")
        links = both.withColumn("overlap", overlap).where(self._enough(F.col("overlap"), "size_a", "size_b"))
        return self.work.materialize(links.select("a", "b", "size_a", "size_b", "overlap"), name)[0]

    def _common(self, size) -> Column:
        """``in_common`` as a column."""
        p, q = self.threshold.numerator, self.threshold.denominator
        return F.least(F.floor(size / SPARE) + 1, F.ceil(size * F.lit(p) / F.lit(q)))

    def _near(self) -> DataFrame:
        """For each shared n-gram, its classes against the first and against the one before: at most two pairs for each row.

        Those that meet as often as two alike sets must are likely links. This need not find all, the rest comes after.
        """
        rows = []
        for other in ({c: F.col(f"pivot.{c}") for c in ("cls", "size", "able")}, {c: F.col(f"{c}_before") for c in ("cls", "size", "able")}):
            x, y = [other[c].alias(f"{c}_x") for c in other], [F.col(c).alias(f"{c}_y") for c in other]
            rows.append(self.shared.select(*x, *y).where("cls_x IS NOT NULL AND cls_x != cls_y"))
        pairs = rows[0].unionByName(rows[1]).where(self._may_be_alike("size_x", "size_y") & self._able("size_x", "size_y", "able_x", "able_y"))
        first = F.col("cls_x") < F.col("cls_y")
        pairs = pairs.select(
            F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b"), F.when(first, F.col("size_x")).otherwise(F.col("size_y")).alias("size_a"),
            F.when(first, F.col("size_y")).otherwise(F.col("size_x")).alias("size_b"),
        )
        met = pairs.groupBy("a", "b", "size_a", "size_b").agg(F.count(F.lit(1)).alias("n"))
        return met.where(F.col("n") >= self._common(F.least("size_a", "size_b"))).drop("n")

    def candidates(self, labels: DataFrame | None = None) -> DataFrame:
        """Pairs of classes that share enough n-grams of both prefixes and pass the length and positional filters, each once.

        ``labels`` (cls, label) leaves out pairs of one label: groups of classes of one label are paired with groups of another, then their members.
        """
        rows = self.shared.select("gram", "cls", "size", "able", "place")
        if labels is None:
            rows = rows.withColumn("label", F.col("cls"))
        else:
            rows = rows.join(labels.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("label", F.coalesce("root", "cls")).drop("root")
        mixed = rows.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("gram")
        rows, _ = self.work.materialize(rows.join(mixed, "gram", "left_semi"), "mixed")
        groups = rows.groupBy("gram", "label").agg(F.min("size").alias("low"), F.max("size").alias("high"), F.max("able").alias("able"))
        p, q = self.threshold.numerator, self.threshold.denominator
        one, two = (groups.select("gram", *[F.col(c).alias(f"{c}_{side}") for c in ("label", "low", "high", "able")]) for side in "ab")
        meet = one.join(two, "gram").where(
            (F.col("label_a") < F.col("label_b")) & (F.col("high_a") * q >= F.col("low_b") * p) & (F.col("high_b") * q >= F.col("low_a") * p) & self._able("low_a", "low_b", "able_a", "able_b")
        )
        meet, _ = self.work.materialize(meet, "meet")
        # two groups that share too few n-grams have no alike members
        often = meet.groupBy("label_a", "label_b").agg(F.count(F.lit(1)).alias("n"), F.min(F.least("low_a", "low_b")).alias("low")).where(F.col("n") >= self._common(F.col("low")))
        members = rows.groupBy("label", "cls", "size", "able").agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("prefix"))
        members, _ = self.work.materialize(members.select("label", "cls", "size", "able", "prefix.place", "prefix.gram"), "prefixes")
        held = members.groupBy("label").agg(F.count(F.lit(1)).alias("held"))
        sides = often.join(held.withColumnsRenamed({"label": "label_a", "held": "held_a"}), "label_a").join(held.withColumnsRenamed({"label": "label_b", "held": "held_b"}), "label_b")
        fewer = F.col("held_a") <= F.col("held_b")
        sides = sides.select(F.when(fewer, F.col("label_a")).otherwise(F.col("label_b")).alias("label_x"), F.when(fewer, F.col("label_b")).otherwise(F.col("label_a")).alias("label_y"))
        # the members of the smaller group meet those of the larger one; the join itself applies all filters
        x, y = (members.select(*[F.col(c).alias(f"{c}_{side}") for c in members.columns]) for side in "xy")
        pairs = sides.join(x, "label_x").join(y, "label_y").where(self._may_be_alike("size_x", "size_y") & self._able("size_x", "size_y", "able_x", "able_y") & self._prefixes_meet())
        first = F.col("cls_x") < F.col("cls_y")
        return pairs.select(
            F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b"), F.when(first, F.col("size_x")).otherwise(F.col("size_y")).alias("size_a"),
            F.when(first, F.col("size_y")).otherwise(F.col("size_x")).alias("size_b"),
        )

    def _prefixes_meet(self) -> Column:
        """Whether the prefixes of x and y share enough, and leave enough after what they share: the positional filter.

        All that is shared up to the last shared n-gram of the prefixes is counted; beyond it, no more than either has left.
        """

        def enough(both):
            def left(side):
                place = F.get(F.col(f"place_{side}"), (F.array_position(F.col(f"gram_{side}"), F.element_at(both, -1)) - 1).cast("int"))
                return F.col(f"size_{side}") - place - 1

            n = F.size(both)
            return F.when(n >= self._common(F.least("size_x", "size_y")), self._enough(n + F.least(left("x"), left("y")), "size_x", "size_y")).otherwise(False)

        return let(F.array_intersect("gram_x", "gram_y"), enough)

    def roots(self) -> DataFrame:
        """(cls, root) of every class: the class itself or the one that stands for all it is linked with.

        A group of alike classes isn't paired all with all: each n-gram's classes are first compared with one of them and with their neighbour, which joins most of a
        group; then every pair that is left between different groups is compared, so no link between groups is lost.
        """
        near = self.verify(self._near(), "near")
        labels, _ = self.work.materialize(connected_components(near, "a", "b"), "labels")
        rest = self.verify(self.candidates(labels), "rest")
        # the stars so far and the links between them
        links = labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest.select("a", "b"))
        stars = connected_components(links, "a", "b").withColumnRenamed("node", "cls")
        classes = self.docs.where("cls IS NOT NULL").select("cls").distinct()
        return self.work.materialize(classes.join(stars, "cls", "left").select("cls", F.coalesce("root", "cls").alias("root")), "roots")[0]


def jaccard_pairs(docs: DataFrame, n: int = 5, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and the membership of documents.

    Returns (a, b, size_a, size_b, overlap), a row for each pair of classes at or above the threshold, and (doc_id, cls, size). Documents of one
    class are linked by being in it; their pairs are not listed. The number of pairs is that of the links, so use ``jaccard_components`` where only groups are asked for.
    """
    join = Join(docs, n, threshold, id_column, text_column)
    return join.verify(join.candidates(), "links"), join.docs


def jaccard_components(docs: DataFrame, n: int = 5, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id that links lead to) of every row.

    Words are runs without blanks, A-Z as a-z; a set holds the distinct runs of n words, or the whole text where it has fewer. A text that is null or without
    words has an empty set, links with nothing and is its own component. Rows with equal sets are linked whatever their ids are; a null id
    counts as greater than all others, and a component without any id has a null one. Other columns are not read.
    """
    join = Join(docs, n, threshold, id_column, text_column)
    firsts = join.docs.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("first")).join(join.roots(), "cls")
    firsts, _ = join.work.materialize(firsts, "firsts")
    component = firsts.join(firsts.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("cls", "component_id")
    sole = join.docs.where("cls IS NULL").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return join.docs.where("cls IS NOT NULL").join(component, "cls").select("doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(sole)


def deduplicate(docs: DataFrame, n: int = 5, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component (see ``jaccard_components``), with all its columns: that of the smallest id, a null id last; of equal ids the one whose text has the least hash.

    Of rows with equal id and text, any one stays. Texts that are null or without words are no copies of anything and all stay.
    """
    join = Join(docs, n, threshold, id_column, text_column)
    members = join.docs.where("cls IS NOT NULL").groupBy("doc_id", "text_hash", "cls").agg(F.count(F.lit(1)).alias("copies")).join(join.roots(), "cls")
    members, _ = join.work.materialize(members, "members")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = members.groupBy("root").agg(F.min(order).alias("_kept"))
    members = members.join(kept, "root").withColumn("stays", order == F.col("_kept"))
    gone, _ = join.work.materialize(members.where("NOT stays OR copies > 1").select("doc_id", "text_hash", "stays"), "gone")
    # rows whose key is surely not among those that go are not shuffled with their texts
    key = F.xxhash64("doc_id", "text_hash")
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(gone.select(key.alias("key")), "key"))

    @F.pandas_udf("boolean")
    def may_go(keys):
        import pandas as pd

        return pd.Series(passes(bits.value, keys.to_numpy()))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *_row_key(id_column, text_column)).withColumn("_may_go", may_go(key))
    doubtful = rows.where("_may_go")

    def same(keys: DataFrame) -> Column:
        return doubtful["doc_id"].eqNullSafe(keys["doc_id"]) & (doubtful["text_hash"] == keys["text_hash"])

    repeated = gone.where("stays")
    once = doubtful.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return rows.where("NOT _may_go").unionByName(doubtful.join(gone, same(gone), "left_anti")).unionByName(once).select("_doc.*")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles at 85 %."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4, threshold=0.85)
