"""Secret scan: candidates against a plain version, and accuracy of the forest on documents it was not trained on."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from skyledger.llm import secret_scan as S

SCHEMA = "doc_id bigint, text string, source string, finding string, word string, probability string"


def rows():
    rng = random.Random(11)
    plain = [f"{a}{b}" for a in "wind rain snow leaf stone river cloud light".split() for b in ("", "ing", "ed", "s")]
    out = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        key = hashlib.sha1(str(i).encode()).hexdigest()
        at, kind = rng.randrange(len(words)), i % 4
        if kind == 0:
            words[at:at] = rng.choice(["token =", "password:", "api_key ="]).split() + [f'"{key}"']
        elif kind == 1:
            words[at:at] = rng.choice([["commit", key], ["sha1", f"({key})"], ["uuid", f"{key[:8]}-{key[8:12]}-{key[12:16]}-{key[16:20]}-{key[20:32]}"]])
        elif kind == 2:
            words[at:at] = ["see", "/".join(rng.choice(plain) for _ in range(6)), "or", "".join(rng.choice(plain) for _ in range(4)), "in", str(rng.randrange(10**15, 10**16))]
        out.append((i, " ".join(words), f"src{i % 3}"))
    return out


def table(spark, given):
    return spark.createDataFrame([(i, t, s, "f", "w", "p") for i, t, s in given], SCHEMA).repartition(4)


def test_candidates(spark):
    given = rows()[:60] + [(None, "\x0b null-id 0123456789abcdef0123,ABCDEFGHIJKLMNOPQRST", None), (7, None, "s"), (8, "", "s"), (9, "   ", "s"), (10, "a" * 30000, "s"), (10, "a" * 30000, "s")]
    got = sorted(((r["doc_id"], r["word_no"], r["finding"], r["before"], r["after"]) for r in S.find_candidates(table(spark, given), path_column="source").collect()), key=str)
    want = []
    for i, text, _ in given:
        words = re.sub(r"[\x09-\x0D]", " ", text or "").strip(" ")
        words = re.split(" +", words)
        for k, word in enumerate(words):
            want += [(i, k, f, " ".join(words[max(0, k - 3) : k]), " ".join(words[k + 1 : k + 3])) for f in re.findall(S.CANDIDATE, word)]
    assert got == sorted(want, key=str) and len(got) > 60


def test_forest_tells_secrets_from_the_rest(spark):
    docs = table(spark, rows())
    words = S.dictionary(docs)
    label = (F.col("doc_id") % 4 == 0).cast("int")
    scanner = S.train(S.find_candidates(docs.where("doc_id < 200"), path_column="source").withColumn("label", label), words)
    held = S.find_candidates(docs.where("doc_id >= 200"), path_column="source")
    assert {r["doc_id"] for r in S.scan(docs.where("doc_id >= 200"), scanner, path_column="source").collect()} == {i for i in range(200, 400) if i % 4 == 0}
    assert held.count() == scanner.score(held).count() > 100
    again = S.train(S.find_candidates(docs.where("doc_id < 200").repartition(2), path_column="source").withColumn("label", label), words)
    a, b = (sorted((r["doc_id"], r["word_no"], round(r["probability"], 9)) for r in s.score(held).collect()) for s in (scanner, again))
    assert a == b


def test_one_kind_of_label_and_empty_table(spark):
    docs = table(spark, rows()[:20])
    found = S.find_candidates(docs)
    scanner = S.train(found.withColumn("label", F.lit(0)), S.dictionary(docs))
    assert scanner.forest is None and S.scan(docs, scanner).count() == found.count()
    assert S.train(found.withColumn("label", F.lit(None).cast("int")), S.dictionary(docs)).forest is None
    assert S.scan(docs.limit(0), scanner).collect() == []


def test_rule_label(spark):
    found = S.find_candidates(spark.createDataFrame([(0, 'my token = "9f86d081884c7d659a2feaa0" here'), (1, "token 9f86d081884c7d659a2feaa0"), (2, 'password="abcdefghijklmnopqrst"'), (3, "api_key: your-key-1234567-example")], "doc_id bigint, text string"))
    assert {r["doc_id"]: r["label"] for r in found.withColumn("label", S.rule_label()).collect()} == {0: 1, 1: 0, 2: 0, 3: 0}
