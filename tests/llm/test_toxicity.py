"""The toxicity network: words and windows against plain loops, gradients against differences, states against a plain recurrence, and held-out accuracy."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import toxicity as T


def plain_words(text):
    data = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode()
    return [run[k : k + T.LETTERS] for run in re.findall(rb"[0-9a-z\x80-\xff]+", data) for k in range(0, len(run), T.LETTERS)]


TEXTS = ["", "a", "The CAT's  mat!", None, "x" * 100, "é漢字" * 20 + " end", "...", "one two " * 200, "tail", "Z9"]


def test_words_and_windows():
    words, sizes, bounds = T.cut_words(pa.array(TEXTS))
    got = [bytes(w[:n]) for w, n in zip(words, sizes)]
    assert [got[a:b] for a, b in zip(bounds, bounds[1:])] == [plain_words(t or "") for t in TEXTS]
    keys = T.word_keys(words)
    assert len({k for k in keys}) == len(set(got))
    first, size, text = T.windows_of(bounds)
    expected = []
    for t, (a, b) in enumerate(zip(bounds, bounds[1:])):
        at = a
        while at < b:
            expected.append((at, min(T.WINDOW, b - at), t))
            if at + T.WINDOW >= b:
                break
            at += T.STEP
    assert list(zip(first, size, text)) == expected


def plain_logit(net, vectors):
    """The network on one window, word by word."""
    sig = lambda x: 1 / (1 + np.exp(-x))

    def run(rows, name):
        size = net[name + "_back"].shape[0]
        h, out = np.zeros(size), []
        for x in rows:
            g, u = x @ net[name + "_in"] + net[name + "_bias"], h @ net[name + "_back"]
            z, r = sig(g[:size] + u[:size]), sig(g[size : 2 * size] + u[size : 2 * size])
            new = np.tanh(g[2 * size :] + r * u[2 * size :])
            h = (1 - z) * new + z * h
            out.append(h)
        return out

    rows = []
    for known, word in vectors:
        chars = [net["chars"][c] for c in word]
        rows.append(np.concatenate([net["words"][known], run(chars, "cf")[-1], run(chars[::-1], "cb")[-1]]))
    states = [np.concatenate(x) for x in zip(run(rows, "wf"), run(rows[::-1], "wb")[::-1])]
    score = np.array([np.tanh(s @ net["look"]) @ net["at"] for s in states])
    weight = np.exp(score - score.max())
    return float((weight / weight.sum()) @ np.array(states) @ net["out"] + net["out_bias"][0])


def small_network():
    seen = T.Texts(pa.array(["the cat sat on the mat", "a bb ccc dddd", "x" * 30 + " y", "é z"]))
    vocabulary = seen.keys[::2]
    return seen, vocabulary, T.new_network(vocabulary, np.random.default_rng(1))


def test_logits():
    seen, vocabulary, net = small_network()
    got = seen.logits(net, vocabulary)
    known = T._known(seen.keys, vocabulary)
    wide = {k: v.astype(float) for k, v in net.items()}
    for k, (first, size) in enumerate(zip(seen.first, seen.sizes)):
        ids = seen.word[first : first + size]
        assert got[k] == pytest.approx(plain_logit(wide, [(known[i], bytes(seen.words[i][: seen.letters[i]])) for i in ids]), abs=1e-5)


def test_gradients():
    seen, vocabulary, net = small_network()
    order = np.argsort(-seen.sizes, kind="stable")
    rest = (T._known(seen.keys, vocabulary), seen.words, seen.letters, seen.index(order), seen.sizes[order], np.array([1.0, 0, 1, 0]), np.array([0.1, 0.2, 0.3, 0.4]))
    grad, _ = T.gradients(net, *rest)
    rng = np.random.default_rng(2)
    for name, value in net.items():
        way = rng.standard_normal(value.shape).astype(np.float32)

        def loss(by):
            return T.gradients(net | {name: value + by * way}, *rest)[1]

        assert (loss(3e-3) - loss(-3e-3)) / 6e-3 == pytest.approx(float((grad[name] * way).sum()), rel=0.02, abs=2e-3), name


SCHEMA = "doc_id bigint, text string, score string, row string"


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = "ba de ki lo mu ra se ti".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.choice([5, 30, 150]))]
        toxic = i % 3 == 0
        for _ in range(toxic * rng.randint(1, 3)):
            # one insult as a word, one that only its beginning tells
            words.insert(rng.randrange(len(words)), rng.choice(["vuxo", "grumpf" + rng.choice(syllables) + rng.choice(syllables)]))
        rows.append((i, " ".join(words), "old", "r"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark, tmp_path):
    rows, labels = corpus(900, 1)
    odd = [(None, "vuxo ba", "old", "r"), (2000, None, "old", "r"), (2001, "", "old", "r"), (2002, " ?! ", "old", "r"), (2003, "ba de " * 50_000 + "vuxo", "old", "r"), (2004, "ba lo", None, None), (2004, "ba lo", None, None)]
    labels += [(None, 1), (2000, 1), (2001, None), (5000, 0), (2004, 0), (2004, 0)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = T.op12_toxicity(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    got = got.collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in got}
    held = [r for r in got if r["held_out"]]
    assert 0 < len(held) < len(got) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= T.THRESHOLD) for r in got)
    right = [r["predicted"] == (r["doc_id"] % 3 == 0) for r in held if r["doc_id"] < 900]
    assert sum(right) / len(right) > 0.95
    assert [by_id[k]["score"] for k in (2000, 2001, 2002)] == [0, 0, 0]
    assert by_id[2003]["predicted"] == 1 and by_id[None]["predicted"] == 1
    assert len({r["score"] for r in got if r["doc_id"] == 2004}) == 1


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b", "old", "r")], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert T.sample_labels(docs, labels) == ([], [], 0.0) and T.train([], [], 0.0) is None
    got = T.score_texts(docs, None)
    assert got.columns == [*docs.columns, "toxicity"] and got.first()["toxicity"] == 0
    assert T.score_texts(docs.limit(0), None).collect() == []


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(T, "TRAINED_ON", 20)
    monkeypatch.setattr(T, "TRAINED_BYTES", 2000)
    rows, labels = corpus(300, 3)
    texts, kinds, share = T.sample_labels(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
    whole = {r[1] for r in rows}
    assert share == pytest.approx(1 / 3) and all(t in whole for t in texts)
    for k in (0, 1):
        mine = [t for t, x in zip(texts, kinds) if x == k]
        assert 1 <= len(mine) <= 20 and (len(mine) == 1 or sum(len(t) for t in mine) <= 2000)
    assert not math.isnan(share)
