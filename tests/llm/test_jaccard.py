"""The Jaccard join against all pairs, and connected components against union-find."""

import random
import re
from itertools import combinations

import pytest

from skyledger.llm.components import connected_components
from skyledger.llm.jaccard import deduplicate, jaccard_components, jaccard_pairs

SCHEMA = "doc_id bigint, text string, cls bigint, gram string, size string"


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def linked(a, b, percent):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def edited(words, rng, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of", "and"] * 20
    texts = [None, "", "   ", "one", "One", "one two", "one two three four", "ONE two\tthree\nfour", "x" * 5000, "x" * 5000]
    base = [rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(300)]
    texts += [" ".join(edited(base, rng, 0.004)) for _ in range(60)]  # one large group of near copies
    texts += [" ".join(base)] * 5
    chain = list(base)
    for _ in range(12):  # each like the one before, the first not like the last
        chain = edited(chain, rng, 0.02)
        texts.append(" ".join(chain))
    for _ in range(40):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 200))]
        texts += [" ".join(own), " ".join(edited(own, rng, rng.choice((0.01, 0.03, 0.2))))]
    texts.append(" ".join(f"long{i % 9973}" for i in range(60000)))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [(i * 3, t) for i, t in zip(ids, texts)]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_components(spark, rows, n, percent):
    docs = spark.createDataFrame([(i, t, 0, "g", "s") for i, t in rows], SCHEMA).repartition(7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, n, percent / 100).collect()}
    sets = {i: shingles(t, n) for i, t in rows}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if linked(sets[a], sets[b], percent)]
    roots = union_find(sets, links)
    assert got == {i: (len(s), roots[i]) for i, s in sets.items()}


def test_pairs(spark, rows):
    docs = spark.createDataFrame([(i, t, 0, "g", "s") for i, t in rows], SCHEMA)
    pairs, members = jaccard_pairs(docs, 4, 0.85)
    cls = {r["doc_id"]: r["cls"] for r in members.collect()}
    sets = {i: shingles(t, 4) for i, t in rows}
    by_class = {cls[i]: s for i, s in sets.items() if s}
    assert len(by_class) == len(set(by_class.values())) and all((cls[i] is None) == (not s) for i, s in sets.items())
    want = {tuple(sorted((a, b))): len(by_class[a] & by_class[b]) for a, b in combinations(by_class, 2) if linked(by_class[a], by_class[b], 85)}
    got = [(r["a"], r["b"], r["overlap"]) for r in pairs.collect()]
    assert len(got) == len(want) and {(a, b): n for a, b, n in got} == want


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (5, "other words are here"), (None, text), (None, "only without an id here"), (7, None), (7, None), (None, ""), (2, text + " more")]
    docs = spark.createDataFrame([(i, t, 1, "g", "s") for i, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()), key=str)
    assert got == sorted([(5, 36, 2), (5, 36, 2), (5, 1, 5), (None, 36, 2), (None, 1, None), (7, 0, 7), (7, 0, 7), (None, 0, None), (2, 37, 2)], key=str)
    kept = sorted([(r["doc_id"], r["text"]) for r in deduplicate(docs).collect()], key=str)
    assert kept == sorted([(5, "other words are here"), (None, "only without an id here"), (7, None), (7, None), (None, ""), (2, text + " more")], key=str)
    assert deduplicate(docs).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jaccard_components(docs).collect() == [] and deduplicate(docs).collect() == []


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 70)] + [(200, 200 + i) for i in range(1, 50)] + [(300, 300), (400, 401), (401, 400), (400, 401)]
    links += [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    want = {n: r for n, r in union_find({n for x in links for n in x}, links).items() if n != r}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").collect() == []
