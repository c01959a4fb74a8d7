"""Periodic runs against a search over every start and period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from skyledger.llm import periodic_runs as P

BLANKS = " \t\n\v\f\r"


def plain_words(text):
    out = [""]
    for c in text or "":
        if c in BLANKS:
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def plain_runs(words):
    """Every maximal stretch of every period, if no smaller period fits it."""
    found, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(24, 3 * q) and not any(all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, q)):
                found.append((start, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = plain_words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digest)


def texts(rng):
    """Random words with planted runs, nested and touching ones among them."""
    out = []
    for _ in range(rng.randint(0, 6)):
        size = rng.choice([1, 2, 3, 5, 9, 13, 20])
        phrase = [rng.choice("abcdefgh") for _ in range(size)]
        out += (phrase * rng.randint(1, 9))[: rng.randint(1, 100)]
        out += [rng.choice(["a", "b", "x" + str(rng.randint(0, 99))]) for _ in range(rng.randint(0, 30))]
    return out


@pytest.mark.parametrize("seed", range(30))
def test_runs(seed):
    rng = random.Random(seed)
    many = [texts(rng) for _ in range(10)] + [[], ["a"], ["a"] * 23, ["a"] * 24, ["a", "b"] * 12, list("abcdefgh") * 3, list("abcdefghi") * 2 + list("abcdefgh"), ["x"] * 100 + ["y"] + ["x"] * 50]
    got = P.runs_of([[w.encode() for w in t] for t in many])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(t) for t in many]


def test_splitting_is_stable():
    rng = random.Random(1)
    ids = np.array([rng.randint(1, 40) for _ in range(2000)] + [41, 42] * 20)
    place = P.split_by_frequency(ids, np.zeros(len(ids), np.int64))
    segments = np.split(place, np.flatnonzero(np.diff(place) > 1) + 1)
    assert all(len(s) >= 24 and min(np.unique(ids[s], return_counts=True)[1]) >= 3 for s in segments)
    assert set(range(2000, 2040)) <= set(place.tolist())


def test_long_period():
    """A phrase of 30,000 words three times over, and one word a million times."""
    rng = random.Random(2)
    phrase = [str(rng.randint(0, 10**6)).encode() for _ in range(30_000)]
    assert P.runs_of([phrase * 3, [b"a"] * 1_000_000])[0].tolist() == [[0, 90_000, 30_000]]


def test_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(texts(rng)), "s") for i in range(150)] + [(i, rng.choice(BLANKS).join(rng.choice("abc") * rng.randint(1, 2) for _ in range(200)), "s") for i in range(150, 190)]
    rows += [(200, None, "s"), (201, "", "s"), (None, "a b " * 30, "s"), (3, " \t\n", "s"), (5, "Ünï x y é " * 30, None), (5, "Ünï x y é " * 30, None), (7, "A a " * 30, "s")]
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows[:190])
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = P.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([plain_row(r[0], r[1]) for r in rows], key=str)


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b " * 20, "old", "t", [1])], "`row` int, text string, periodic string, found string, `a.b` array<int>")
    got = P.find_periodic_runs(docs)
    assert got.columns == ["row", "text", "found", "a.b", "periodic"]
    row = got.first()
    assert row["row"] == 1 and row["found"] == "t" and row["a.b"] == [1] and row["periodic"]["collapsed"] == "a b"
    assert [tuple(r) for r in row["periodic"]["runs"]] == [(0, 40, 2)]
    assert P.find_periodic_runs(docs.limit(0)).collect() == []
