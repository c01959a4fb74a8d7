"""Row numbers, pages and offsets over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.workspace import Workspace


def number_rows(rows: DataFrame, order_by, name: str = "row_no") -> DataFrame:
    """Add the position of each row in the order, from 0.

    A row's number is its place in its range of the order plus the sizes of the ranges before it, so no task sees all rows. Rows
    that tie are told apart by a serial number, so a third of all rows under one key still spreads over many ranges. The rows are
    shuffled and written once, by range; only the sizes of the ranges are joined to them.
    """
    work = Workspace(rows.sparkSession)
    ranged = rows.withColumn("_serial", F.monotonically_increasing_id()).repartitionByRange(*order_by, "_serial").sortWithinPartitions(*order_by, "_serial")
    # the lower bits of the id count the rows of a partition
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed, _ = work.materialize(ranged.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")).drop("_serial"), "ranges")
    # one row per range
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before, _ = work.materialize(sizes.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_before")), "sizes")
    numbered = placed.join(before, "_range").withColumn(name, F.col("_before") + F.col("_place"))
    return numbered.select(*[F.col(f"`{c}`") for c in rows.columns], name)


def number_pages(rows: DataFrame, page_size: int, order_by=("id",)) -> DataFrame:
    """Add ``page_no``: rows in order, ``page_size`` to a page."""
    numbered = number_rows(rows, order_by, "_row_no")
    return numbered.withColumn("page_no", F.floor(F.col("_row_no") / F.lit(page_size)).cast("bigint")).drop("_row_no")


def offset_rows(rows: DataFrame, offset: int, order_by=("page_pos", "dfs_path")) -> DataFrame:
    """All rows but the first ``offset`` in order. Spark's own OFFSET without a LIMIT passes every row through one task."""
    return number_rows(rows, order_by, "_row_no").where(F.col("_row_no") >= offset).drop("_row_no")
