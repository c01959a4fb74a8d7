"""Alignments against a plain Smith-Waterman, and planted copies."""

import random
import re

import numpy as np

from skyledger.llm.decontamination import GAP, MATCH, MISMATCH, align, decontaminate, find_contamination

SCHEMA = "doc_id bigint, text string, doc_key string, item string, words string"


def plain_score(passage, item):
    best, rows = 0, [[0] * (len(passage) + 1)]
    for x in item:
        row = [0]
        for j, y in enumerate(passage, 1):
            row.append(max(0, rows[-1][j - 1] + (MATCH if x == y else MISMATCH), rows[-1][j] + GAP, row[-1] + GAP))
        rows.append(row)
        best = max(best, *row)
    return best


def test_align():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        score, start, end = align(np.array(a), np.array(b))
        assert score == (plain_score(a, b) if a and b else 0)
        assert not score or plain_score(a[start:end], b) == score


def words(rng, n):
    return [rng.choice(["the", "of", "and", "in"]) if rng.random() < 0.4 else f"w{rng.randrange(3000)}x" for _ in range(n)]


def build():
    rng = random.Random(6)
    items = {k: words(rng, rng.randrange(15, 60)) for k in range(12)}
    items[50] = ["solo", "item"]
    docs, planted = {}, set()
    for i in range(300):
        text = words(rng, rng.randrange(1, 400))
        if i % 5 == 0:  # copies with words replaced, dropped and added
            k = rng.randrange(12)
            copy = [w for w in items[k] for w in ([] if rng.random() < 0.05 else [f"new{rng.randrange(99)}"] if rng.random() < 0.07 else [w, "extra"] if rng.random() < 0.04 else [w])] if i % 10 else items[k]
            at = rng.randrange(len(text) + 1)
            text[at:at] = copy
            planted.add((i, k))
        elif i % 7 == 0:  # a third of an item is no copy
            text[0:0] = items[3][: len(items[3]) // 3]
        docs[i] = " ".join(text)
    docs[400], docs[401], docs[402] = docs[0].upper().replace(" ", "! "), "", "x " * 60000 + " ".join(items[5]) + " y" * 60000
    planted |= {(400, next(k for i, k in planted if i == 0)), (402, 5)}
    docs[403] = "here a Solo, item!"
    planted.add((403, 50))
    return items, docs, planted


def test_planted_copies(spark):
    items, docs, planted = build()
    hot = [(1000 + i, f"before{i} " + " ".join(items[7]) + f" after{i}") for i in range(150)]  # an item that a third of all documents has
    rows = [*docs.items(), *hot, (None, " ".join(items[2])), (0, docs[0]), (9, None)]
    table = spark.createDataFrame([(i, t, "k", "i", "w") for i, t in rows], SCHEMA).repartition(6)
    benchmark = spark.createDataFrame([(k, " ".join(w), "z") for k, w in items.items()] + [(60, None, "z"), (61, "", "z"), (2, " ".join(items[2]), "z")], "item_id bigint, text string, seed string")
    found = find_contamination(table, benchmark).collect()
    want = planted | {(i, 7) for i, _ in hot} | {(None, 2)}
    assert len(found) == len(want) and {(r["doc_id"], r["item_id"]) for r in found} == want
    texts = dict(rows)
    for r in found:
        text = re.findall(r"[a-z0-9]+", (" ".join(items[2]) if r["doc_id"] is None else texts[r["doc_id"]]).lower())
        assert abs(r["score"] - plain_score(text[r["start_word"] : r["end_word"]], items[r["item_id"]]) / (MATCH * len(items[r["item_id"]]))) < 1e-12
    clean = decontaminate(table, benchmark)
    dirty = {i for i, _ in want}
    assert clean.columns == table.columns and sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in rows if i not in dirty)


def test_empty_tables(spark):
    docs, benchmark = spark.createDataFrame([(1, "some text here", "k", "i", "w")], SCHEMA), spark.createDataFrame([(1, "some text here")], "item_id bigint, text string")
    assert find_contamination(docs.limit(0), benchmark).collect() == [] and find_contamination(docs, benchmark.limit(0)).collect() == []
    assert decontaminate(docs, benchmark.limit(0)).count() == 1 and decontaminate(docs, benchmark).count() == 0
