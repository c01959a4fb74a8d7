"""Chains of ``next`` links."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.links import container_nodes
from skyledger.workspace import Workspace


def follow_chain(heads: DataFrame, edges: DataFrame, work: Workspace) -> DataFrame:
    """Every node on the chains that begin at ``heads`` (node, ...payload), with its position ``pos`` counted from 0.

    ``edges`` (src, dst) holds at most one successor per node. Pointer jumping: each round knows four times as many positions as
    the one before and makes its strides four times as long, so a chain of n nodes takes log4(n) rounds of joins on a unique key,
    however long it is. A chain that runs into a circle is cut where it would repeat itself; at most some four times the nodes on it are written for that.
    """
    payload = [c for c in heads.columns if c != "node"]
    whose = F.xxhash64(*payload) if payload else F.lit(0).cast("bigint")
    known = heads.select("node", *payload, F.lit(0).cast("bigint").alias("pos"), whose.alias("_head"))
    path, n = work.write(known, "chain-known-0")
    schema, paths, step = known.schema, [path], 1
    if not n["n_rows"]:
        return work.read(schema, path).drop("_head")
    single = edges.select("src", F.array("dst").alias("ahead"))
    jumps, m = work.materialize(_stretch(single, 1), "chain-jumps-1")
    n_edges = m["n_rows"]
    with ThreadPoolExecutor(1) as aside:
        while n["n_rows"] and step <= n_edges + 1:
            # the next strides come from these strides alone, so they are made while these are walked
            longer = aside.submit(work.materialize, _stretch(jumps, 4), f"chain-jumps-{step * 4}") if step * 4 <= n_edges + 1 else None
            so_far = work.read(schema, *paths)
            reached = so_far.join(jumps, F.col("node") == F.col("src")).select(
                *payload, "pos", "_head", F.posexplode("ahead").alias("_i", "_dst")
            )
            reached = reached.select(F.col("_dst").alias("node"), *payload, (F.col("pos") + (F.col("_i") + 1) * step).alias("pos"), "_head")
            # a walk that meets what it has passed runs in a circle: it ends there, however many other edges there are
            reached = reached.join(so_far.select("node", "_head"), ["node", "_head"], "left_anti")
            reached = reached.groupBy("node", "_head").agg(F.min("pos").alias("pos"), *[F.first(c).alias(c) for c in payload]).select(*schema.names)
            path, n = work.write(reached, f"chain-known-{step * 4}")
            paths.append(path)
            step *= 4
            jumps = longer.result()[0] if longer else jumps
    return work.read(schema, *paths).drop("_head")


def _stretch(jumps: DataFrame, by: int) -> DataFrame:
    """Jumps (src, ahead) of one, two and three strides, as far as the chain goes. ``by`` 1 takes the stride from ``ahead`` alone,
    4 makes four old strides the new one."""

    def follow(rows: DataFrame, at, hop: DataFrame) -> DataFrame:
        hop = hop.select(F.col("src").alias("_mid"), F.col("to").alias("_far"))
        return rows.join(hop, at == F.col("_mid"), "left").drop("_mid")

    single = jumps.select("src", F.get("ahead", F.lit(0)).alias("to"))
    if by == 4:
        third = jumps.select("src", F.get("ahead", F.lit(2)).alias("third"))
        single = follow(third, F.col("third"), single).where("_far IS NOT NULL").select("src", F.col("_far").alias("to"))
    two = follow(single.withColumnRenamed("to", "a"), F.col("a"), single).withColumnRenamed("_far", "b")
    three = follow(two, F.col("b"), single).withColumnRenamed("_far", "c")
    return three.select("src", F.array_compact(F.array("a", "b", "c")).alias("ahead"))


def one_document_each(rows: DataFrame, address: str) -> None:
    """Raise where two documents have one address; following links would multiply what lies behind them."""
    twice = rows.groupBy(address).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"{twice['n']} documents have the address '{twice[address]}'; keep the latest of them (response_documents(..., latest=True))")


def follow_pages(documents: DataFrame, first_uris) -> DataFrame:
    """Pages (first_uri, page_pos, doc_uri, body) of the chains of ``next`` links that begin at the given address or addresses."""
    spark = documents.sparkSession
    work = Workspace(spark)
    firsts = [first_uris] if isinstance(first_uris, str) else list(first_uris)
    heads = spark.createDataFrame([(u, u) for u in dict.fromkeys(firsts)], "node string, first_uri string")
    edges, _ = work.materialize(container_nodes(documents).where("next_uri IS NOT NULL").select(F.col("doc_uri").alias("src"), F.col("next_uri").alias("dst")), "edges")
    one_document_each(edges, "src")
    chain = follow_chain(heads, edges, work).select("first_uri", F.col("pos").alias("page_pos"), F.col("node").alias("doc_uri"))
    return chain.join(documents, "doc_uri").select("first_uri", "page_pos", "doc_uri", "body")


def matched_audit(pages: DataFrame, row_limit: int | None = None) -> DataFrame:
    """Per chain: the number of matches its pages announce against the features really returned."""
    parsed = F.from_json("body", "numberMatched VARIANT, features ARRAY<STRING>")
    n_features = F.size(F.filter(F.col("p.features"), lambda f: f.startswith("{")))
    matched = F.try_variant_get("p.numberMatched", "$", "bigint")
    is_int = F.schema_of_variant("p.numberMatched") == "BIGINT"
    counted = pages.select("first_uri", parsed.alias("p")).select(
        "first_uri", F.when(is_int, matched).alias("matched"), F.greatest(n_features, F.lit(0)).cast("bigint").alias("n")
    )
    totals = counted.groupBy("first_uri").agg(
        F.max("matched").alias("number_matched"), F.sum("n").alias("returned"), F.count(F.lit(1)).alias("n_pages")
    )
    percent = F.least(F.lit(100.0), F.try_divide(F.lit(100.0) * F.col("returned"), F.col("number_matched")))
    has_both = (F.col("number_matched") > 0) & (F.col("returned") > 0)
    large = F.lit(row_limit is None) & (F.col("number_matched") > LARGE_RESULT)
    return totals.select(
        "*", F.when(has_both, percent).otherwise(0.0).alias("percent"), F.coalesce(large, F.lit(False)).alias("is_large")
    )


# Fixed value: an unlimited search with more matches than this is flagged.
LARGE_RESULT = 2048
