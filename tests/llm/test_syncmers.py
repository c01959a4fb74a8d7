"""Closed syncmers against a plain version on the same hashes."""

import hashlib

import regex
import xxhash
from pyspark.sql import functions as F

from skyledger.llm.syncmers import K, S, WORD, closed_syncmers, match_anchors, op2_syncmers


def spark_hash(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
        seed -= (1 << 64) * (seed >= 1 << 63)
        seed &= (1 << 64) - 1
    return seed - (1 << 64) * (seed >= 1 << 63)


def plain(text, k=K, s=S):
    words = regex.findall(WORD, (text or "").lower())
    if not words:
        return []
    if len(words) < k:
        return [(0, spark_hash("\n".join(words)))]
    runs = [spark_hash(*words[i : i + s]) for i in range(len(words) - s + 1)]
    width = k - s + 1
    kmers = [(i, spark_hash(*runs[i : i + width])) for i in range(len(runs) - width + 1)]
    chosen = [x for x in kmers if min(runs[x[0] : x[0] + width]) in (runs[x[0]], runs[x[0] + width - 1])]
    return chosen or [min(kmers, key=lambda x: (x[1], x[0]))]


TEXTS = [None, "", "  \t\n", "one", "A b C d", "a b c d e", "the same the same the same the same the same", "รกข漢字テスト mixed ünïcode 漢字",
         " ".join(f"w{i * i % 37}" for i in range(400)), "x" * 20000, "a b c d e"]


def test_anchors(spark):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "n int, text string, _words string")
    rows = closed_syncmers(docs).collect()
    assert {r["_words"] for r in rows} == {"kept"} and len(rows) == len(TEXTS)
    for r in rows:
        assert [(a["at"], a["hash"]) for a in r["anchors"]] == plain(TEXTS[r["n"]])


def test_other_lengths_and_empty_table(spark):
    docs = spark.createDataFrame([(TEXTS[8],)], "text string")
    for k, s in ((3, 1), (4, 4), (8, 3)):
        assert [(a["at"], a["hash"]) for a in closed_syncmers(docs, k, s).first()["anchors"]] == plain(TEXTS[8], k, s)
    assert closed_syncmers(docs.limit(0)).collect() == []


def test_moved_passages_match_by_position(spark):
    passage = " ".join(f"p{i * 7 % 101}" for i in range(60))
    row = closed_syncmers(closed_syncmers(spark.createDataFrame([(f"a b c {passage}", f"{passage} z")], "x string, y string"), text_column="x", into="ax"), text_column="y", into="ay")
    pairs = row.select(match_anchors(F.col("ax"), F.col("ay"))).first()[0]
    assert len(pairs) > 10 and {p["at_a"] - p["at_b"] for p in pairs} == {3}


def jaccard(a, b):
    a, b = ({x[1] >> 32 for x in plain(t)} for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query(spark, tmp_path):
    texts = [(3, TEXTS[8]), (1, "one two three four five six seven eight nine ten eleven"), (1, None), (None, "first by its null id"), (7, TEXTS[8]), (9, TEXTS[8]), (9, TEXTS[8]), (8, ""), (12, "é漢" * 50)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(op2_syncmers(spark, str(tmp_path)).collect(), key=str)
    assert len(got) == len(texts)
    tie = {r[0]: r[0] for r in texts}
    ids = sorted({(i is not None, i or 0) for i in tie})
    by_id = {}
    for i, t in texts:
        by_id.setdefault(i, []).append(t or "")
    order = []
    for known, i in ids:
        own = by_id[i if known else None]
        own = list(dict.fromkeys(own))
        if len(own) > 1:  # ties are in the order of Spark's hash of the text
            hashes = {t: spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t", F.lit(not known))).first()[0] for t in own}
            own.sort(key=hashes.get)
        order += [(i if known else None, t) for t in own]
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        rows = [r for r in got if r["doc_id"] == i and r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()]
        assert len(rows) == sum((a, b or "") == (i, text) for a, b in texts)
        for r in rows:
            assert abs(r["near_edited"] - jaccard(text, edited)) < 1e-12 and abs(r["near_next"] - jaccard(text, after)) < 1e-12
            assert r["fingerprint"] == "".join(f"{m & 0xFFFFFFFF:08x}" for m in sorted({x[1] >> 32 for x in plain(text)}))
