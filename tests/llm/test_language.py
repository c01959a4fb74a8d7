"""Language profiles against plain counting, and held-out accuracy."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyledger.llm import language as L

SCHEMA = "doc_id bigint, text string, lang string, language string, gram string"


def plain_grams(text):
    words = "".join(c if L._letters()[ord(c)] != L.BLANK else " " for c in text).split()
    out = Counter()
    for word in words:
        padded = " " + "".join(c.lower() if len(c.lower()) == 1 else c for c in word) + " "
        for n in (1, 2, 3):
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    del out[" "]
    return out


def key(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


@pytest.mark.parametrize("text", ["a", "Ab cd", "the THE the", "漢字 x", "ünï-cödé 12 İ", "Привет, мир! " * 50, "नमस्ते दुनिया", "x" * 3000])
def test_counts(text, monkeypatch):
    for piece in (L.PIECE, 7, 2, 1):
        monkeypatch.setattr(L, "PIECE", piece)
        keys, counts = L.count_grams(L.code_points(text))
        assert dict(zip(keys.tolist(), counts.tolist())) == {key(g): n for g, n in plain_grams(text).items()}


def plain_predict(text, profiles):
    own = [g for g, _ in sorted(plain_grams(text).items(), key=lambda x: (-x[1], key(x[0])))][: L.PROFILE]
    away = {lang: sum(abs(i - p.index(key(g))) if key(g) in p else L.PROFILE for i, g in enumerate(own)) for lang, p in profiles.items()}
    best = min(away, key=lambda lang: (away[lang], lang))
    return best, 1 - away[best] / (L.PROFILE * len(own))


def test_learn_and_identify(spark):
    rng = random.Random(4)
    syllables = {"aa": "ba de ki lo mu".split(), "bb": "sch ung ein ver ch".split(), "cc": "при вет мир да".split()}
    rows = [(i, " ".join("".join(rng.choice(syllables[x]) for _ in range(3)) for _ in range(30)), x, "old", "g") for i, x in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(100, None, "aa", "old", "g"), (101, "", "aa", "old", "g"), (102, "123 !?", None, "old", "g"), (None, "badeki", None, "old", "g"), (103, "schung ungein", None, "old", "g"), (103, "schung ungein", None, "old", "g")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    profiles = L.learn_profiles(docs)
    counts = {x: Counter() for x in syllables}
    for _, text, lang, *_ in rows:
        if lang and text:
            counts[lang].update(plain_grams(text))
    assert profiles == {x: [key(g) for g, _ in sorted(c.items(), key=lambda y: (-y[1], key(y[0])))][: L.PROFILE] for x, c in counts.items()}
    got = L.identify(docs, profiles).collect()
    assert len(got) == len(rows) and set(docs.columns) == set(L.identify(docs, profiles).columns)
    for r in got:
        if r["text"] in (None, "", "123 !?"):
            assert tuple(r["language"]) == ("und", 0.0)
        else:
            lang, score = plain_predict(r["text"], profiles)
            assert r["language"]["language"] == lang and abs(r["language"]["score"] - score) < 1e-12
            assert r["lang"] in (None, lang)


def test_nothing_to_learn_and_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "text here", None, "o", "g")], SCHEMA)
    assert L.learn_profiles(docs) == {} and L.learn_profiles(docs.limit(0)) == {}
    assert tuple(L.identify(docs, {}).first()["language"]) == ("und", 0.0)
    assert L.identify(docs.limit(0), {}).collect() == []
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError):
        L.learn_profiles(spark.createDataFrame([(i, "text", f"l{i}", "o", "g") for i in range(3)], SCHEMA))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = L.op7_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").select(F.col("lang") == F.col("lang_pred")).collect()
    assert sum(r[0] for r in rows) >= 0.98 * len(rows) > 0


def test_a_filter_on_the_result_predicts_once(spark):
    """A filter below the prediction would predict again, and each prediction of a task has a worker of its own."""
    docs = spark.createDataFrame([(1, "abc abd", "aa"), (2, "xyz xyy", "bb"), (3, None, None)], "doc_id bigint, text string, lang string")
    found = L.identify(docs, L.learn_profiles(docs))
    floors = spark.createDataFrame([("aa", 2, 0.1)], "language string, size int, floor double")
    for plan in (L.in_a_language(found, floors, into="language"), L.score_floors(found.where("lang IS NOT NULL"))):
        assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r["doc_id"], r["language"]["language"]) for r in L.in_a_language(found, floors).collect()) == [(1, "aa"), (2, "bb")]
