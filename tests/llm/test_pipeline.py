"""The pipeline stage by stage against plain versions, and the registration of the corpus queries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_jaccard import linked, shingles, union_find
from tests.llm.test_mixing import targets

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = {"aa": "ba de ki lo mu ra".split(), "bb": "sch ung ein ver ch tz".split()}


def build():
    rng = random.Random(20)

    def prose(lang, n):
        return ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]

    items = [prose("aa", 25) for _ in range(4)]
    rows = []
    for i in range(80):
        words = prose("aa" if i % 3 else "bb", rng.randrange(30, 90))
        if i % 9 == 0:
            words[5:5] = items[i % 4]
        rows.append((i, " ".join(words), "aa" if i % 3 else "bb", ["s1", "s2", None][i % 3]))
        if i % 8 == 0:  # copies, exact and nearly
            rows.append((100 + i, " ".join(words), "aa", "s2"))
            rows.append((200 + i, " ".join([*words[:-1], "end"]), None, "s1"))
    rows += [(300, None, "aa", "s1"), (301, "", "aa", "s1"), (302, "123 456 !?", "aa", "s1"), (303, rows[5][1], "aa", "s1"), (303, rows[5][1], "aa", "s1"), (304, "ŷŵ ŷŵŷ ŵŵ", None, "s1")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], [(k, " ".join(w)) for k, w in enumerate(items)]


def test_stages(spark, tmp_path):
    rows, items = build()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, stages = spark.read.parquet(str(tmp_path / "documents.parquet")), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "copies", "benchmarks", "mix", "tokens"]

    def run(name, docs):
        out = stages[name](spark, docs, str(tmp_path))
        assert name == "tokens" or out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    kept = run("language", docs)
    got = sorted((r["doc_id"], r["lang"]) for r in kept.collect())
    assert got == sorted((i, "bb" if any(x in t for x in ("sch", "ung", "ein", "ver", "tz")) else "aa") for i, t, *_ in rows if i not in (300, 301, 302, 304))

    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    sets = {i: shingles(t, 5) for i, t in texts.items()}
    ids = sorted(sets)
    roots = union_find(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if linked(sets[a], sets[b], 80)])
    unique = run("copies", kept)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(i for i in ids if roots[i] == i) != ids

    clean = run("benchmarks", unique)
    wanted = [i for i in sorted(r["doc_id"] for r in unique.collect()) if not any(t in texts[i] for _, t in items)]
    assert sorted(r["doc_id"] for r in clean.collect()) == wanted

    mixed = run("mix", clean)
    own = {r["doc_id"]: (r["source"], len(r["text"].split())) for r in clean.collect()}
    sizes = {}
    for source, n in own.values():
        sizes[source] = sizes.get(source, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = targets(sizes, {s: [3, 1, 2][k % 3] for k, s in enumerate(order)})
    copies = []
    for i, (source, _) in own.items():
        rate = goal[source] / sizes[source]
        copies += [i] * (int(rate) + (int(hashlib.md5(f"6:{i}".encode()).hexdigest()[:13], 16) / 2**52 < rate - int(rate)))
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(copies)

    plain, at, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for i in sorted(copies):
        tokens = np.array([*plain.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(tokens), zlib.crc32(tokens.tobytes())))
        at += len(tokens)
    assert sorted(map(tuple, run("tokens", mixed).collect()), key=lambda r: r[1]) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=lambda r: r[1]) == want


def test_short_texts_of_a_large_script_stay(spark, tmp_path):
    """In a script of thousands of characters short texts have low scores for their own language; what is in no language still goes."""
    rng = random.Random(21)
    signs = [chr(0x4E00 + k) for k in range(3000)]
    weights = [1 / (k + 1) for k in range(3000)]
    text = lambda n: "".join(rng.choices(signs, weights, k=n))
    rows = [(i, text(1500), "zh", "s", 0) for i in range(40)] + [(100 + i, text(rng.randint(40, 60)), "zh" if i % 2 else None, "s", 0) for i in range(120)]
    rows += [(300 + i, " ".join("".join(rng.choice(SYLLABLES["aa"]) for _ in range(3)) for _ in range(40)), "aa", "s", 0) for i in range(40)]
    rows += [(400 + i, " ".join("".join(rng.choice("ŷŵẑ") for _ in range(5)) for _ in range(9)), None, "s", 0) for i in range(5)]
    kept = dict(corpus_pipeline.STAGES)["language"](spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in kept) == sorted((r[0], "zh" if r[0] < 300 else "aa") for r in rows if r[0] < 400)


def test_empty_and_null_documents(spark, tmp_path):
    spark.createDataFrame([(1, "item text of some words")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in ([], [(None, None, None, None, None)] * 2):
        docs = spark.createDataFrame(rows, SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.count() == (0 if name in ("language", "mix") else len(rows)), name


def test_tasks_get_batches_of_bounded_size(spark, tmp_path):
    """A batch is bounded by the bytes of its texts, not by 10,000 rows; a session's own bound stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 600, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 4000) AS text", "'aa' AS lang", "'s' AS source", "20000L AS n_chars")

    def sizes(batches):
        yield from (pa.RecordBatch.from_pydict({"n": [batch.nbytes]}) for batch in batches)

    spark.conf.unset(key)
    try:
        dict(corpus_pipeline.STAGES)["mix"](spark, docs, str(tmp_path))
        seen = [r["n"] for r in docs.mapInArrow(sizes, "n bigint").collect()]
        assert sum(seen) > 600 * 20_000 and max(seen) < 3 << 20
        spark.conf.set(key, "65536")
        dict(corpus_pipeline.STAGES)["mix"](spark, docs, str(tmp_path))
        assert spark.conf.get(key) == "65536"
    finally:
        spark.conf.unset(key)


def test_registration():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
