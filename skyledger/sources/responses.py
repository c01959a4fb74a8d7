"""Landed API responses (url, method, headers, content_type, body_sent, status, fetched_at, body)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators.pages import follow_chain
from skyledger.workspace import Workspace


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def response_documents(responses: DataFrame, on_error: str = "fail", latest: bool = False) -> DataFrame:
    """Responses as documents. A status other than 200 raises, is dropped, or is listed (``report``).

    ``latest`` keeps the last response of each address, as a reader of the live catalog would see it; following links needs one
    document per address. An address that was fetched very often is reduced before the shuffle.
    """
    if latest:
        row = F.max_by(F.struct("status", "body"), "fetched_at").alias("r")
        responses = responses.groupBy("url").agg(row).select("url", "r.status", "r.body")
    bad = F.coalesce(F.col("status") != 200, F.lit(True))
    if on_error == "report":
        return responses.where(bad).select("url", "status")
    if on_error == "fail":
        text = F.format_string("response for '%s' has status %s", "url", F.col("status").cast("string"))
        responses = responses.where(F.when(bad, F.raise_error(text).cast("boolean")).otherwise(True))
    elif on_error != "drop":
        raise ValueError("on_error must be 'fail', 'drop' or 'report'")
    return responses.where(~bad).select(F.col("url").alias("doc_uri"), "body")


def request_key(url: Column, method: Column, headers: Column, content_type: Column, body: Column) -> Column:
    """Two requests with one key are the same request. Header order and the case of the method do not matter, an absent part is an empty one."""
    blank = F.lit("")
    sent = F.coalesce(F.array_sort(F.map_entries(headers)), F.expr("cast(array() as array<struct<key:string,value:string>>)"))
    parts = F.struct(url.alias("url"), F.upper(method).alias("method"), F.coalesce(body, blank).alias("body"), F.coalesce(content_type, blank).alias("type"), sent.alias("sent"))
    # as JSON no part can run into the next one; hashed, a long body is not shuffled
    return F.sha2(F.to_json(parts), 256)


def freshest_response(responses: DataFrame, ttl_seconds: int = 30) -> DataFrame:
    """Responses that were really fetched: one that comes within the time limit of the last fetched one is a reuse of it. Failed
    responses (a status other than 200) are left out, whatever the limit; without a limit nothing is a reuse.

    The first response of a request is kept, then always the next one later than the limit. No request's history is gathered in
    one place: its times are put in order by ranges, each finds its successor there, and the kept times are the chains of successors,
    walked by doubling.
    """
    if ttl_seconds <= 0:
        return responses.where(F.col("status") == 200)
    reusable = F.upper("method").isin("GET", "POST")
    key = request_key(*[F.col(c) for c in ("url", "method", "headers", "content_type", "body_sent")])
    keyed = responses.where(F.col("status") == 200).withColumn("_key", key)
    micros = F.unix_micros(F.col("fetched_at").cast("timestamp"))
    keyed = keyed.withColumn("_at", micros)

    ttl = ttl_seconds * 1_000_000
    work = Workspace(responses.sparkSession)
    times, _ = work.materialize(keyed.where(reusable).select("_key", "_at").distinct(), "times")
    linked, _ = work.materialize(_linked(times, ttl, work), "linked")

    name = F.struct("_key", "_at")
    surely_starts = F.coalesce(F.col("_at") - F.col("before") > ttl, F.lit(True))
    heads = linked.where(~F.col("probe") & surely_starts).select(name.alias("node"))
    # a time that starts a run on its own is a head already, so chains end before it
    edges = linked.where(F.col("probe") & (F.col("after") - F.col("before") <= ttl)).select(name.alias("src"), F.struct("_key", F.col("after").alias("_at")).alias("dst"))
    kept = follow_chain(heads, edges, work).select("node._key", "node._at")
    fetched = keyed.where(reusable).join(kept, ["_key", "_at"], "left_semi")
    return fetched.unionByName(keyed.where(~reusable)).drop("_key", "_at")


def _linked(times: DataFrame, ttl: int, work: Workspace) -> DataFrame:
    """Each time twice, as an event and as a probe ``ttl`` later: the last event of its request before it, and for a probe the first one after it.

    Events and probes are put in order by ranges of request and time, so a request with a third of all responses is cut into many. Neighbours are
    looked for inside a range; only the first and the last event of a range are carried over to its neighbours.
    """
    event = times.select("_key", F.col("_at").alias("t"), F.lit(False).alias("probe"), "_at")
    # an event at the very time of a probe comes before it: it is within the limit
    probe = times.select("_key", (F.col("_at") + ttl).alias("t"), F.lit(True).alias("probe"), "_at")
    order = ["_key", "t", "probe"]
    ranged = event.unionByName(probe).repartitionByRange(*order)
    ranged, _ = work.materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")

    happened = F.when(~F.col("probe"), F.struct("_key", "_at"))
    ends = ranged.groupBy("_range").agg(F.min(happened).alias("first"), F.max(happened).alias("last"))
    # one row per range
    along = Window.orderBy("_range")
    carried, _ = work.materialize(ends.select(
        "_range", F.last("last", True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("carried_before"),
        F.last("first", True).over(Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)).alias("carried_after"),
    ), "carried")
    forwards, backwards = Window.partitionBy("_range").orderBy(*order), Window.partitionBy("_range").orderBy(*[F.desc(c) for c in order])
    inside = ranged.withColumn("before", F.last(happened, True).over(forwards.rowsBetween(Window.unboundedPreceding, -1)))
    inside = inside.withColumn("after", F.last(happened, True).over(backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = inside.join(carried, "_range").withColumns({"before": F.coalesce("before", "carried_before"), "after": F.coalesce("after", "carried_after")})

    def of_request(name: str) -> Column:
        return F.when(F.col(f"{name}._key") == F.col("_key"), F.col(f"{name}._at")).alias(name)

    return found.select("_key", "_at", "probe", of_request("before"), of_request("after"))
