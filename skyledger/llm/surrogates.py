"""Surrogates for personal data (operator 1).

Found entities are replaced by others of their type, made from a secret key and the entity alone: the same entity gets the same surrogate in every document and spelling,
whichever task meets it. Surrogates keep the format (separators, case, length of numbers, check digits), the script and, for names, the gender.

Two entities of one type must not share a surrogate, and none may be an entity that occurs. Spark compares all surrogates with each other and with all entities;
those that collide try again with a higher attempt number until none does. Only the attempts of those few travel to the documents that mention them.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.workspace import Workspace

# Common given and family names by script and gender, titles with their gender, alphabets, address ranges for private use.
GIVEN = {
    ("latin", "m"): "James John Robert Michael David William Thomas Daniel Peter Paul Hans Karl Jean Pierre Luis Carlos Jorge Miguel Antonio Andreas".split(),
    ("latin", "f"): "Mary Linda Susan Sarah Karen Emma Anna Laura Julia Claire Marie Sophie Ingrid Petra Carmen Lucia Elena Isabel Teresa Monika".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил".split(), ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Светлана Татьяна".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Νίκος Κώστας Γιάννης Παύλος".split(), ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Ειρήνη".split(),
}
FAMILY = {
    "latin": "Smith Jones Brown Taylor Walker Hughes Carter Schmidt Weber Fischer Becker Martin Bernard Dubois Laurent Garcia Lopez Romero Navarro Vargas Berg Lund Rossi Costa".split(),
    "cyrillic": "Иванов Петров Смирнов Кузнецов Попов Соколов Волков Морозов".split(), "greek": "Παππάς Γεωργίου Νικολάου Ιωάννου Δημητρίου Αντωνίου".split(),
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Madam": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Dr": "", "Prof": "", "г-н": "m", "г-жа": "f", "κ": "m", "κα": "f"}
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")
#: tries after which an address gets one more letter, after which a number leaves its private range or first digit, and later rounds without any progress after which no surrogate is left
WIDER, WIDEST, STUCK = 4, 256, 20
PRIVATE = (((10,), 1), ((192, 168), 2), ((127,), 1), ((169, 254), 2))

_GENDER = {name.casefold(): g for (_, g), names in GIVEN.items() for name in names}
_WORD = r"[^\W\d_][^\W\d_'’-]*(?:['’-][^\W\d_]+)*"
_UPPER = r"(?=[A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆΈΉΊΌΎΏ])"
PATTERNS = {
    "email": re.compile(r"(?<![\w.+%-])[\w.+%-]{1,64}@(?:[^\W_](?:[\w-]{0,61}[^\W_])?\.){1,8}[^\W\d_]{2,24}(?![\w-])"),
    "iban": re.compile(r"(?<![^\W_])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![^\W_])"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "phone": re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![^\W_])|(?<![\w+-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\w-])"),
    "card": re.compile(r"(?<![^\W_])(?<!\d[.-])\d(?:[ -]?\d){12,18}(?![^\W_])"),
}
_TITLED = re.compile(rf"(?<!\w)({'|'.join(sorted(TITLES, key=len, reverse=True))})\b\.?[ \t]+({_UPPER}{_WORD}(?:[ \t]+{_UPPER}{_WORD}){{0,2}})")
_NAMED = re.compile(rf"(?<!\w)({'|'.join(n for names in GIVEN.values() for n in names)})[ \t]+({_UPPER}{_WORD})")


@cache
def _cues() -> ahocorasick.Automaton:
    """Finds titles and given names, without which a text has no name."""
    automaton = ahocorasick.Automaton()
    for cue in [*TITLES, *[n for names in GIVEN.values() for n in names]]:
        automaton.add_word(cue, len(cue))
    automaton.make_automaton()
    return automaton


def _may_have_names(text: str) -> bool:
    for last, size in _cues().iter(text):
        before, after = text[last - size : last - size + 1] if last >= size else "", text[last + 1 : last + 2]
        if not before.isalnum() and not after.isalnum():
            return True
    return False


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _script(word: str) -> str:
    first = word[:1].lower()
    return "cyrillic" if first in ALPHABETS[1] or first == "ё" else "greek" if first and "Ͱ" <= first <= "Ͽ" else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, entity) of every entity, left to right without overlaps; of overlapping ones the first type in the order of PATTERNS, then names.

    The entity is the spelling-free form: digits of a number, lower case of an address or a name. Types of names carry script and gender.
    """
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    digit, at = re.search(r"\d", text), "@" in text
    for kind, pattern in PATTERNS.items():
        if kind == "email" and not at or kind != "email" and not digit:
            continue
        own = []
        for m in pattern.finditer(text):
            entity = re.sub(r"\D", "", m[0])
            if kind == "email":
                entity = m[0].lower()
            elif kind == "ip":
                entity = ".".join(str(int(x)) for x in m[0].split("."))
            elif kind == "iban":
                entity = m[0].replace(" ", "")
                if _mod97(entity) != 1:
                    continue
            elif kind == "phone":
                if not 7 <= len(entity) <= 15:
                    continue
                if len(entity) == 11 and m[0].startswith("+1"):
                    entity = entity[1:]  # with and without its country code it is one number
            own.append((m.start(), m.end(), kind, entity))
        if own and taken:
            own = [x for x in own if _free(taken, x[0], x[1])]
        found += own
        taken = sorted(taken + [x[:2] for x in own])
    if not _may_have_names(text):
        return sorted(found)
    names = []
    for m in _TITLED.finditer(text):
        words = [(m.start(2) + w.start(), m.start(2) + w.end(), w[0]) for w in re.finditer(r"\S+", m[2])]
        gender = TITLES[m[1]] or next((_GENDER[w.casefold()] for _, _, w in words if w.casefold() in _GENDER), "")
        names += _parts(words, gender, len(words) > 1)
    for m in _NAMED.finditer(text):
        names += _parts([(m.start(1), m.end(1), m[1]), (m.start(2), m.end(2), m[2])], _GENDER[m[1].casefold()], True)
    if names:  # the same names without a title, in the same text
        known = {x[3]: x for x in names if len(x[3]) > 1}
        for m in re.finditer(rf"(?<!\w){_UPPER}{_WORD}", text):
            if m[0].casefold() in known:
                names.append((m.start(), m.end(), *known[m[0].casefold()][2:]))
    for x in sorted(set(names)):
        if _free(taken, x[0], x[1]):
            found.append(x)
            insort(taken, x[:2])
    return sorted(found)


def _free(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span meets none of the sorted ones."""
    k = bisect_left(taken, (start, end))
    return (k == len(taken) or taken[k][0] >= end) and (k == 0 or taken[k - 1][1] <= start)


def _parts(words: list[tuple[int, int, str]], gender: str, has_given: bool) -> Iterator[tuple[int, int, str, str]]:
    """Given names but for the last word, which is the family name. A family name is one entity in either gender."""
    for k, (start, end, word) in enumerate(words):
        if has_given and k < len(words) - 1:
            yield start, end, f"given:{_script(word)}:{gender or _GENDER.get(word.casefold(), '') or 'm'}", word.casefold()
        else:
            low = word.casefold()
            feminine = _script(word) == "cyrillic" and re.search(r"(?:ова|ева|ёва|ина|ына)$", low)
            yield start, end, f"family:{_script(word)}", low[:-1] if feminine else low


class Maker:
    """Makes surrogates from a key."""

    def __init__(self, key: bytes):
        self.key = key

    def numbers(self, kind: str, entity: str, attempt: int) -> Iterator[int]:
        """An endless sequence of numbers below 2^32 that only the key, the entity and the attempt decide."""
        block = 0
        while True:
            digest = hmac.new(self.key, f"{kind}\0{entity}\0{attempt}\0{block}".encode(), hashlib.sha256).digest()
            yield from (int.from_bytes(digest[k : k + 4], "big") for k in range(0, 32, 4))
            block += 1

    def _like(self, text: str, numbers: Iterator[int]) -> str:
        """Digits for digits, letters of the same alphabet for letters, all else as it is."""
        out = []
        for c in text:
            alphabet = next((a for a in ALPHABETS if c.lower() in a), None)
            if c.isdecimal():
                out.append(str(next(numbers) % 10))
            elif alphabet or c.isalpha():
                new = (alphabet or ALPHABETS[0])[next(numbers) % len(alphabet or ALPHABETS[0])]
                out.append(new.upper() if c.isupper() else new)
            else:
                out.append(c)
        return "".join(out)

    def make(self, kind: str, entity: str, attempt: int) -> str:
        """The surrogate of an entity in its spelling-free form."""
        numbers = self.numbers(kind, entity, attempt)
        if kind == "email":
            local, _, host = entity.rpartition("@")
            *labels, name, top = host.split(".")
            kept = f"example.{top}" if top in ("com", "net", "org") else f"{self._like(name, self.numbers('host', name, 0))}.example"
            more = "".join(ALPHABETS[0][next(numbers) % 26] for _ in range(min(attempt // WIDER, 24)))  # more entities than local parts of that length
            return self._like(local, numbers) + more + "@" + "".join(self._like(x, self.numbers("host", x, 0)) + "." for x in labels) + kept
        if kind == "ip":
            octets = [int(x) for x in entity.split(".")]
            kept = next((n for start, n in PRIVATE if tuple(octets[:n]) == start), 0)
            if kept and attempt >= WIDEST:
                octets, kept = [10, *octets[1:]], 1  # more entities than addresses of that range
            new = octets[:kept] + [next(numbers) % 254 + 1 for _ in octets[kept:]]
            if not kept:
                new[0] = next(numbers) % 100 + 11  # public unicast, none of the private ranges
            return ".".join(map(str, new))
        if kind == "card":
            new = entity[0] + "".join(str(next(numbers) % 10) for _ in entity[2:])
            return new + str(next(c for c in range(10) if (_luhn(f"{new}{c}") == 0) == (_luhn(entity) == 0)))
        if kind == "iban":
            new = entity[:2] + "00" + self._like(entity[4:], numbers)
            return new[:2] + f"{98 - _mod97(new):02d}" + new[4:]
        if kind == "ssn":
            return "9" + "".join(str(next(numbers) % 10) for _ in entity[1:])  # area numbers from 900 are never given out
        if kind == "phone":
            first = str(next(numbers) % 9 + 1) if attempt >= WIDEST else entity[:1]
            return first + "".join(str(next(numbers) % 10) for _ in entity[1:])
        part, script, *gender = kind.split(":")
        names = GIVEN[script, gender[0]] if part == "given" else FAMILY[script]
        new = names[next(numbers) % len(names)]
        while attempt >= len(names):  # more entities than names: compounds
            attempt //= len(names)
            new += "-" + names[next(numbers) % len(names)]
        return new.casefold()

    @staticmethod
    def _cased(word: str) -> str:
        return "-".join(x[:1].upper() + x[1:] for x in word.split("-"))

    def spell(self, kind: str, mention: str, surrogate: str) -> str:
        """A surrogate in the spelling of a mention."""
        if kind in ("card", "ssn", "phone", "iban"):
            before = sum(c.isalnum() for c in mention) - len(surrogate)  # a country code that the entity leaves out
            rest = iter(re.sub(r"\W", "", mention)[:before] + surrogate)
            return "".join(next(rest, "") if c.isalnum() else c for c in mention)
        if kind.startswith("family:cyrillic") and re.search(r"(?:ова|ева|ёва|ина|ына)$", mention.casefold()):
            surrogate = "-".join(x + "а" for x in surrogate.split("-"))
        if mention.isupper() and len(mention) > 1:
            return surrogate.upper()
        if kind.startswith(("given", "family")) and mention[:1].isupper():
            return self._cased(surrogate)
        return surrogate

    def replace(self, text: str, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
        """The text with surrogates, and how many entities it had."""
        out, at, found = [], 0, find(text)
        for start, end, kind, entity in found:
            out += [text[at:start], self.spell(kind, text[start:end], self.make(kind, entity, attempts.get((kind, entity), 0)))]
            at = end
        return "".join(out) + text[at:], len(found)


def _names(kind: Column) -> Column:
    """Entities that must have different surrogates: those of one kind, and given names of both genders."""
    return F.when(kind.startswith("given:"), F.regexp_replace(kind, ":[mf]$", "")).otherwise(kind)


def _attempts(entities: DataFrame, maker: Maker, work: Workspace) -> DataFrame:
    """(kind, entity, attempt) of the entities whose surrogate is not that of attempt 0."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, own, tries = (batch.column(k).to_pylist() for k in range(3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([maker.make(*x) for x in zip(kinds, own, tries)], pa.string())], ["kind", "entity", "attempt", "surrogate"])

    schema = "kind string, entity string, attempt bigint, surrogate string"
    settled, open_, round_, before, stuck = None, entities.withColumn("attempt", F.lit(0).cast("bigint")), 0, -1, 0
    originals = entities.select(_names(F.col("kind")).alias("_group"), F.col("entity").alias("surrogate")).distinct()
    while True:
        made, _ = work.materialize(open_.select("kind", "entity", "attempt").mapInArrow(make, schema), f"made-{round_}")
        # of those that share a surrogate the settled one stays, else the first by entity
        every = made.withColumn("_old", F.lit(False))
        if settled is not None:
            every = every.unionByName(settled.withColumn("_old", F.lit(True)))
        first = F.row_number().over(Window.partitionBy("_group", "surrogate").orderBy(F.col("_old").desc(), "entity", "kind"))
        every = every.withColumn("_group", _names(F.col("kind"))).withColumn("_first", first)
        seen = every.join(originals.withColumn("_real", F.lit(True)), ["_group", "surrogate"], "left")
        seen, _ = work.materialize(seen.withColumn("_good", (F.col("_first") == 1) & F.col("_real").isNull()).drop("_group", "_first", "_real", "_old"), f"seen-{round_}")
        settled = seen.where("_good").drop("_good")
        open_, left = work.materialize(seen.where("NOT _good").select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), f"open-{round_}")
        round_ += 1
        if not left["n_rows"]:
            return settled.where("attempt > 0").select("kind", "entity", "attempt")
        before, stuck = left["n_rows"], stuck + 1 if round_ > WIDEST and left["n_rows"] == before else 0
        if stuck >= STUCK:
            kinds = [r["kind"] for r in open_.select("kind").distinct().orderBy("kind").limit(10).collect()]
            raise ValueError(f"no surrogates are left for {before} entities of the kinds {kinds}")


def surrogate(docs: DataFrame, key: bytes, text_column: str = "text", into: str = "n_entities") -> DataFrame:
    """Every document with surrogates in its text, and the number of entities replaced in ``into``.

    Null texts stay null, with 0 entities; texts without entities stay as they are, byte by byte. Equal texts have equal results; all other columns are kept,
    one of the name ``into`` is replaced. The result depends on the key and on which entities the whole table has.
    """
    work, maker = Workspace(docs.sparkSession), Maker(key)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != into]).alias("_doc"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(row, kind, entity) for row, text in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()) for kind, entity in {x[2:] for x in find(text)}]
            for at in range(0, len(out), 100_000):
                r, k, e = zip(*out[at : at + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(k, pa.string()), pa.array(e, pa.string())], ["_row", "kind", "entity"])

    keyed = rows.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("_row"))
    found, _ = work.materialize(keyed.mapInArrow(mentions, "_row bigint, kind string, entity string"), "mentions")
    entities, _ = work.materialize(found.select("kind", "entity").distinct(), "entities")
    # the few entities that had to try again, for the texts that mention them
    again = found.join(_attempts(entities, maker, work), ["kind", "entity"]).groupBy("_row").agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("_again"))
    again, _ = work.materialize(again, "again")

    @F.pandas_udf("struct<text: string, n: bigint>")
    def replaced(texts, attempts):
        import pandas as pd

        known = ({} if a is None else {(x["kind"], x["entity"]): x["attempt"] for x in a} for a in attempts)
        return pd.DataFrame([(None, 0) if t is None else maker.replace(t, k) for t, k in zip(texts, known)], columns=["text", "n"])

    new = rows.withColumn("_row", F.xxhash64("text")).join(again, "_row", "left").select("_doc", replaced("text", "_again").alias("_new"))
    columns = [F.col("_new.text").alias(c) if c == text_column else F.col(f"_doc.`{c}`") for c in docs.columns if c != into]
    return new.select(*columns, F.col("_new.n").alias(into))


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return surrogate(docs, key=b"surrogates of the documents table")
