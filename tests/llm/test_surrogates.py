"""Surrogates: what is found, and that types, formats, distinctness and coreference hold."""

import re

import pytest

from skyledger.llm import surrogates as S
from skyledger.workspace import Workspace

SCHEMA = "doc_id bigint, text string, kind string, entity string, n_entities string"
MAKER = S.Maker(b"a key")


@pytest.mark.parametrize(("text", "entities"), [
    ("mail Jo.Doe+x@Mail.example.com!", [("email", "jo.doe+x@mail.example.com")]),
    ("at 10.0.0.300 or 10.0.0.30, not 1.2.3 or 1.2.3.4.5", [("ip", "10.0.0.30")]),
    ("+1 (017) 555-7713, 017-555-7713.", [("phone", "0175557713")] * 2),
    ("+44 20 7946 0958", [("phone", "442079460958")]),
    ("9807915762804490 4111 1111 1111 1111 x9807915762804490 123456789012", [("card", "9807915762804490"), ("card", "4111111111111111")]),
    ("078-05-1120", [("ssn", "078051120")]),
    ("GB82 WEST 1234 5698 7654 32 and GB83 WEST 1234 5698 7654 32", [("iban", "GB82WEST12345698765432"), ("card", "12345698765432")]),
    ("Mr. John Smith and Frau Weber. Smith came; the smith did not.", [("given:latin:m", "john"), ("family:latin", "smith"), ("family:latin", "weber"), ("family:latin", "smith")]),
    ("Мария Иванова и г-н Иванов", [("given:cyrillic:f", "мария"), ("family:cyrillic", "иванов"), ("family:cyrillic", "иванов")]),
    ("Version 2.0. of the Apache License in 2019, the token 04dbebab91ab85687d33eeaaf9ac699e1188f962", []),
    ("", []), ("@", []), ("Anea. Ofthtioninor wh 12 ed.", []),
])
def test_find(text, entities):
    assert [x[2:] for x in S.find(text)] == entities


def test_surrogates_keep_type_and_format():
    for k in range(200):
        card = MAKER.make("card", f"4{k:014d}", 0)
        assert len(card) == 15 and card[0] == "4"
        valid = MAKER.make("card", "4111111111111111", k)
        assert S._luhn(valid) == 0 and S._luhn(MAKER.make("card", "4111111111111112", k)) != 0
        iban = MAKER.make("iban", "GB82WEST12345698765432", k)
        assert S._mod97(iban) == 1 and re.fullmatch(r"GB\d\d[A-Z]{4}\d{14}", iban)
        assert all(0 < int(x) < 255 for x in MAKER.make("ip", "97.51.17.173", k).split("."))
        assert MAKER.make("ip", "192.168.1.7", k).startswith("192.168.")
        assert MAKER.make("ssn", "078051120", k)[0] == "9"
    text, n = MAKER.replace("Call +1 (017) 555-7713 or 017-555-7713; JOHN SMITH? Mr. John Smith, Mrs. Mary Smith; г-жа Анна Петрова, г-н Петров", {})
    assert n == 11
    m = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4}); ([A-Z]+) ([A-Z]+)\? Mr\. (\w+) (\w+), Mrs\. (\w+) (\w+); г-жа (\w+) (\w+), г-н (\w+)", text)
    a = m.groups()
    assert a[:3] == a[3:6] and a[6] == a[8].upper() and a[7] == a[9].upper() and a[9] == a[11] and a[13] == a[14] + "а"
    assert a[8] in S.GIVEN["latin", "m"] and a[10] in S.GIVEN["latin", "f"] and a[12] in S.GIVEN["cyrillic", "f"] and a[14] in S.FAMILY["cyrillic"]


def spread(text):
    return [(x[2:], text[x[0] : x[1]]) for x in S.find(text)]


def test_distinct_and_same_everywhere(spark):
    rows = [(i, f"from a{i % 40}@b.example.com to 10.0.0.{i % 90 + 1}, Mr. Name{chr(97 + i % 26)}{chr(97 + i % 23)} called") for i in range(300)]  # few surrogates to choose from
    rows += [(1000 + i, f"Herr {chr(65 + i % 26)}{'xyz'[i % 3]}berg") for i in range(78)] + [(None, None), (2005, ""), (2006, "nothing to see"), (2006, "nothing to see"), (2007, "x " * 50000 + "a3@b.example.com")]
    docs = spark.createDataFrame([(i, t, "k", "e", "n") for i, t in rows], SCHEMA).repartition(6)
    got = S.surrogate(docs, b"key").collect()
    again = S.surrogate(docs.repartition(2), b"key").collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    other = S.surrogate(docs, b"another").collect()
    assert sum(a != b for a, b in zip(sorted(map(str, got)), sorted(map(str, other)))) > 250
    texts, mapping = dict(rows), {}
    real = {x for _, t in rows if t for x, _ in spread(t)}
    for r in got:
        old = texts[r["doc_id"]]
        assert r["kind"] == "k" and r["n_entities"] == (len(S.find(old)) if old else 0)
        if not r["n_entities"]:
            assert r["text"] == old
            continue
        pattern = "".join(f"{re.escape(old[a:b])}(.+?)" for a, b in zip([0] + [x[1] for x in S.find(old)], [x[0] for x in S.find(old)])) + re.escape(old[S.find(old)[-1][1] :])
        for ((kind, entity), _), new in zip(spread(old), re.fullmatch(pattern, r["text"], re.S).groups()):
            assert mapping.setdefault((kind, entity), new.casefold()) == new.casefold()
            assert (kind, new.casefold()) not in real
    by_kind = {}
    for (kind, _), new in mapping.items():
        by_kind.setdefault(kind, []).append(new)
    assert len(by_kind["family:latin"]) > 100 and all(len(v) == len(set(v)) for v in by_kind.values())


def test_names_of_all_scripts_alone(spark):
    texts = ["Mr. Smith", "Mme Dubois", "г-н Иванов", "Μαρία Παππάς", "a@b.co", "10.0.0.1"]
    rows = S.surrogate(spark.createDataFrame([(t,) for t in texts], "text string"), b"key").collect()
    assert all(r["n_entities"] == len(S.find(t)) > 0 for r, t in zip(rows, texts))


def test_more_entities_than_surrogates_of_their_length(spark):
    texts = [f"write to {'abcdefgh'[k % 8]}@host{k}.com, not _@host{k}.org" for k in range(40)]
    rows = S.surrogate(spark.createDataFrame([(t,) for t in texts], "text string"), b"key").collect()
    new = [x for r in rows for x in re.findall(r"\S+@[\w.]+\w", r["text"])]
    assert len(new) == len(set(new)) == 80 and not set(new) & {x for t in texts for x in re.findall(r"\S+@[\w.]+\w", t)}
    assert all(x.endswith(("@example.com", "@example.org")) for x in new)


def test_wider_spaces_keep_their_format():
    maker = S.Maker(b"key")
    tries = [*range(12), *range(S.WIDEST, S.WIDEST + 30)]
    for k in tries:
        assert S.find(maker.make("ip", "192.168.3.4", k))[0][2] == "ip" and maker.make("ip", "192.168.3.4", k).startswith("192.168." if k < S.WIDEST else "10.")
        assert len(maker.make("phone", "4930123", k)) == 7 and S.find(maker.make("email", "a@b.com", k))[0][2] == "email"
    assert len({maker.make("phone", "4930123", k)[0] for k in tries}) > 2


def test_nothing_left_is_an_error(spark, monkeypatch):
    class Same(S.Maker):
        def make(self, kind, entity, attempt):
            return "same"

    monkeypatch.setattr(S, "WIDEST", 0)
    monkeypatch.setattr(S, "STUCK", 2)
    entities = spark.createDataFrame([("ssn", "123456789"), ("ssn", "223456789")], "kind string, entity string")
    with pytest.raises(ValueError, match="ssn"):
        S._attempts(entities, Same(b"key"), Workspace(spark))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert S.surrogate(docs, b"key").collect() == [] and sorted(S.surrogate(docs, b"key").columns) == sorted(docs.columns)
