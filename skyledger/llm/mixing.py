"""Mixing sources to target weights (operator 6).

Words per source give each source its target and its rate, target / size. A document is emitted floor(rate) times and once more when a number in [0, 1)
hashed from a seed and its id is below the rate's fraction. So a source's share is met in expectation, reruns agree, and no row waits for another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.workspace import Workspace

#: what a word is in SQL terms: no blanks from U+0009 to U+000D, no U+0020
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(sizes: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): ``share`` of all sizes by weight, at most ``most`` times each size.

    What a source cannot take goes to the others by weight until none is above its limit. That is one level, target = min(limit, level * weight):
    in the order of limit / weight, the first source that would not reach its limit if all before it did gives the level. One row for each
    source is sorted in one task; no row of a document is. Without words, or with no positive weight, every target is 0.
    """
    limit, weight = F.col("source_size") * F.lit(most), F.col("weight").cast("double")
    ahead = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    first = sizes.withColumn("_total", total).where("weight > 0").withColumn("_limit", limit).withColumn("weight", weight)
    ranked = (
        first.withColumn("_rank", F.row_number().over(ahead))
        .withColumn("_taken", F.sum("_limit").over(ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_limit"))
        .withColumn("_left", F.sum("weight").over(ahead.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("_level", (F.col("_total") - F.col("_taken")) / F.col("_left"))
    )
    open_ = F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.struct("_rank", "_level"))
    level = F.min(open_).over(Window.partitionBy())["_level"]
    target = F.when(level.isNull(), F.col("_limit")).otherwise(F.least(F.col("_limit"), level * F.col("weight")))
    found = ranked.select("source", "source_size", "weight", target.alias("target"))
    return found.unionByName(sizes.where("weight IS NULL OR weight <= 0").select("source", "source_size", F.col("weight").cast("double"), F.lit(0.0).alias("target")))


def cycled_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Give the sources, by code point and null last, the weights in turn."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    given = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(given, (place % len(weights)).cast("int")))


def hashed_share(seed: int, doc_id: Column) -> Column:
    """A number in [0, 1) from a seed and an id; the same wherever and whenever it is computed."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def repetitions(
    docs: DataFrame, weights: Sequence[float] | DataFrame = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 6,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", into: str = "mix",
) -> DataFrame:
    """Every document with a struct column ``into``: size, source_size, target, rate and copies.

    ``weights`` are given to the sources in turn, or a DataFrame (source, weight) names them; a source it does not name has weight 0.
    A null source is a source of its own. A null or empty text has size 0, and a source without words rate 0, so its documents go.
    Rows that share an id share the decision. A column of the name ``into`` is replaced; all other columns are kept as they are.
    The sources are counted before any row is shuffled and written as a table, so Spark knows its size when it joins it.
    """
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != into]).alias("_doc"), F.col(f"`{source_column}`").alias("_source"), n_words(F.col(f"`{text_column}`")).alias("_size"))
    sizes = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    if isinstance(weights, DataFrame):
        sizes = sizes.join(weights.select(F.col("source").alias("_named"), "weight"), F.col("source").eqNullSafe(F.col("_named")), "left").drop("_named")
    else:
        sizes = cycled_weights(sizes, weights)
    targets, _ = Workspace(docs.sparkSession).materialize(source_targets(sizes, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.join(targets, F.col("_source").eqNullSafe(F.col("source"))).withColumn("_rate", rate)
    extra = hashed_share(seed, F.col(f"_doc.`{id_column}`")) < F.col("_rate") - F.floor("_rate")
    copies = (F.floor("_rate") + extra.cast("bigint")).cast("bigint")
    mix = F.struct(F.col("_size").alias("size"), "source_size", "target", F.col("_rate").alias("rate"), copies.alias("copies"))
    return joined.select("_doc.*", mix.alias(into))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as its rate and hash say, with the columns of ``docs``."""
    planned = repetitions(docs, into="_mix", **options)
    return planned.where("_mix.copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_mix.copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planned = repetitions(docs)
    return planned.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             CAST(source_size AS DOUBLE) * 2 AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS total FROM s),
r AS (SELECT *, row_number() OVER o AS place,
             (total - (sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap))
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
l AS (SELECT min_by(level, place) AS level FROM r WHERE level * weight <= cap),
t AS (SELECT r.source, r.source_size, CASE WHEN l.level IS NULL THEN r.cap ELSE least(r.cap, l.level * r.weight) END AS target FROM r, l),
x AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             CAST('0x' || substr(md5('6:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM x
"""
