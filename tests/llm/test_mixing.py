"""Mixing against level filling step by step, and its limits."""

import hashlib
import re

from pyspark.sql import functions as F

from skyledger.llm.mixing import mix, op6_mixing, repetitions, source_targets

SCHEMA = "doc_id bigint, text string, source string, mix string, target string"


def targets(sizes, weights, share=1.5, most=2.0):
    """Share out, cap, share the excess out again, until no source is above its limit."""
    left, open_, out = share * sum(sizes.values()), {s for s in sizes if weights[s] > 0}, dict.fromkeys(sizes, 0.0)
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > most * sizes[s]}
        if not full:
            out.update({s: level * weights[s] for s in open_})
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets(spark):
    for sizes, weights in [({"a": 100, "b": 10, "c": 50, None: 3}, [3, 1, 2, 3]), ({"a": 5}, [3]), ({"a": 0, "b": 0}, [3, 1]), ({"a": 0, "b": 7}, [3, 1]), ({str(i): i * i % 97 for i in range(40)}, [3, 1, 2] * 14), ({"a": 9, "b": 9}, [0, 2])]:
        named = dict(zip(sizes, weights))
        rows = spark.createDataFrame([(s, n, float(named[s])) for s, n in sizes.items()], "source string, source_size bigint, weight double")
        got = {r["source"]: r["target"] for r in source_targets(rows, 1.5, 2.0).collect()}
        want = targets(sizes, named)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 for s in want)


def docs_of(spark):
    rows = [(i, " ".join(["w"] * (i % 13)), ["b", "a", None, "ä", "empty"][i % 5 if i % 13 else 4], "kept", "t") for i in range(800)]
    rows += [(None, "null id", "b", "kept", "t"), (3, None, "a", "kept", "t"), (3, None, "a", "kept", "t")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_repetitions_and_mix(spark):
    rows, docs = docs_of(spark)
    planned = repetitions(docs).collect()
    assert len(planned) == len(rows)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"\S+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = targets(sizes, {s: [3, 1, 2][k % 3] for k, s in enumerate(order)})
    for r in planned:
        m, text = r["mix"], r["text"] or ""
        rate = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        share = int(hashlib.md5(f"6:{'null' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        assert m["size"] == len(text.split()) and m["source_size"] == sizes[r["source"]] and abs(m["target"] - want[r["source"]]) < 1e-9
        assert m["copies"] == int(rate) + (share < rate - int(rate)) <= 2
    emitted = {(r["doc_id"], r["text"], r["source"]): r["n"] for r in mix(docs).groupBy("doc_id", "text", "source").agg(F.count("*").alias("n")).collect()}
    planned_copies = {}
    for r in planned:
        key = (r["doc_id"], r["text"], r["source"])
        planned_copies[key] = planned_copies.get(key, 0) + r["mix"]["copies"]
    assert emitted == {k: n for k, n in planned_copies.items() if n}
    assert mix(docs).columns == docs.columns


def test_shares_are_met(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 50 AS int)) AS text", "concat('s', id % 3) AS source")
    got = repetitions(docs).groupBy("source").agg(F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.first("mix.target").alias("target")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.03 for r in got)


def test_named_weights_and_empty_table(spark):
    rows, docs = docs_of(spark)
    only = repetitions(docs, weights=spark.createDataFrame([("a", 1.0), ("nowhere", 5.0)], "source string, weight double"))
    assert {r["source"] for r in only.where("mix.copies > 0").collect()} == {"a"}
    assert repetitions(docs.limit(0)).collect() == [] and mix(docs.limit(0)).collect() == []


def test_query_reruns_agree(spark):
    a, b = (sorted(map(tuple, op6_mixing(spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert a == b and a
