"""The suffix tree against a plain version with dictionaries."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from skyledger.llm import suffix_tree as T

SCHEMA = "doc_id bigint, text string, row string, word string, key string"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def symbols(text):
    return " ".join(tokens(text)).encode() + b"\n"


def plain_tree(texts, least_gain):
    """Contexts that stay, with their counts."""
    counts = [defaultdict(Counter) for _ in range(T.DEPTH + 1)]
    for text in texts:
        s = b"\n" * T.DEPTH + symbols(text)
        for i in range(T.DEPTH, len(s)):
            for d in range(T.DEPTH + 1):
                counts[d][s[i - d : i]][s[i]] += 1
    corpus = sum(counts[0][b""].values())
    stay = {b""}
    for d in range(1, T.DEPTH + 1):
        for context, own in counts[d].items():
            shorter, total = counts[d - 1][context[1:]], sum(own.values())
            gain = sum(n * math.log(n * sum(shorter.values()) / (total * shorter[a])) for a, n in own.items())
            if gain > T.COST * len(own) * math.log(total + 1) and gain >= least_gain * corpus:
                stay |= {context[k:] for k in range(d)}
    return {c: counts[len(c)][c] for c in stay}


def plain_score(tree, text):
    def chance(context, symbol):
        own = tree[context]
        shorter = chance(context[1:], symbol) if context else 1 / 256
        return (own[symbol] + len(own) * shorter) / (sum(own.values()) + len(own)) if own else shorter

    s, out = b"\n" * T.DEPTH + symbols(text), 0.0
    for i in range(T.DEPTH, len(s)):
        context = b""
        for d in range(1, T.DEPTH + 1):
            if s[i - d : i] not in tree:
                break
            context = s[i - d : i]
        out += math.log10(chance(context, s[i]))
    return out


def rows():
    rng = random.Random(8)
    stems = "ka to mi re sun der ing ent é ñ".split()
    texts = [" ".join("".join(rng.choice(stems) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(0, 80))) for _ in range(120)]
    texts += [None, "", " \t ", "Ka TO\x0bmi", "never-seen 漢字 words", "ka to mi", "ka to mi", "\x00 null byte"]
    return list(enumerate(texts)) + [(None, "an id is missing"), (5, "id again")]


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(T, "FREQUENT", 40)
    all_rows = rows()
    docs = spark.createDataFrame([(i, t, "r", "w", "k") for i, t in all_rows], SCHEMA).repartition(5)
    taught = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True))
    train = [t for i, t in all_rows if i is None or i % 4]
    model = T.learn(docs, taught, least_gain=1e-4)
    tree = plain_tree(train, 1e-4)
    assert model.tree.size == len(tree) > 50
    counts = Counter(w for t in train for w in [*tokens(t), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), len(tokens(t)) + 1, sum(counts[w] > 0 for w in [*tokens(t), "\n"]), total, round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in [*tokens(t), "\n"]), 6), round(plain_score(tree, t), 3))
        for i, t in all_rows
    )
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 3)) for r in T.score(docs, model).collect())
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-5 and abs(a[5] - b[5]) < 2e-3 + 1e-5 * abs(b[5])


def test_contexts_of_the_table_only(spark, monkeypatch):
    monkeypatch.setattr(T, "CELLS", 1500)
    all_rows = rows()
    docs = spark.createDataFrame([(i, t, "r", "w", "k") for i, t in all_rows], SCHEMA).repartition(5)
    train = [t for i, t in all_rows if i is None or i % 4]
    model = T.learn(docs, F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True)))
    tree = plain_tree(train, 0)
    assert model.tree.size < 100 < model.contexts.select("depth", "context").distinct().count() == len(tree)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in T.score(docs, model).collect())
    want = sorted((str(i), len(tokens(t)) + 1, plain_score(tree, t)) for i, t in all_rows)
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 2e-3 + 1e-5 * abs(b[2])


def test_rare_contexts_stay_in_a_large_corpus(spark):
    rare = spark.createDataFrame([("xyzzy quux",)] * 3, "text string")
    docs = rare.unionByName(spark.range(0, 400, 1, 4).select(F.repeat(F.lit("ka to mi re "), 3000).alias("text")))
    model = T.learn(docs)
    assert model.tree.size > T.learn(docs, least_gain=1e-6).tree.size
    assert model.tree.score(pa.array(["xyzzy quux"]))[0] > T.learn(docs, least_gain=1e-6).tree.score(pa.array(["xyzzy quux"]))[0]


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab cde f ghi".split()) for _ in range(rng.randrange(200))) + rng.choice(["", " ", "   \n"]) for _ in range(30)] + ["   ", "x" * 100, "y" * 90 + " " * 90, ""]
    counts = plain_tree(texts[:10], 1e-4)
    flat = [(len(c), sum(b << (8 * k) for k, b in enumerate(reversed(c))), s, n) for c, own in counts.items() for s, n in own.items()]
    tree = T.Tree(*[np.array(x, np.int64) for x in zip(*flat)])
    whole = tree.score(pa.array(texts))
    assert np.allclose(whole, [plain_score(counts, t) for t in texts], atol=1e-3)
    monkeypatch.setattr(T, "SLICE", 16)
    monkeypatch.setattr(T, "PIECE", 8)
    assert np.allclose([tree.score(pa.array([t]))[0] for t in texts], whole)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc d", "r", "w", "k")], SCHEMA)
    model = T.learn(docs, F.lit(False))
    got = T.score(docs, model).first()
    assert (got["n_tokens"], got["n_known"], got["train_tokens"], got["base_score"]) == (3, 0, 0, 0.0) and abs(got["score"] - 6 * math.log10(1 / 256)) < 1e-6
    assert T.score(docs.limit(0), model).collect() == []


def test_held_out_texts_gain(spark):
    got = T.op4_suffix_tree(spark, "/root/testdata/sf0.01").where("held_out").collect()
    ids = {r["doc_id"] for r in got}
    assert ids and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
