"""Secret scans with a random forest that removes false positives (operator 8); DataFrame functions and Spark ML only.

Candidates are long runs of the characters that keys and tokens consist of. Each is described by its length and kinds of characters, its character transitions, how much
of it dictionary words cover, its path and the words beside it. A forest trained from labelled findings tells secrets from the rest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import once
from skyledger.llm.language import fold
from skyledger.workspace import Workspace

#: a candidate, and the least length of a word that may hold one
CANDIDATE, LEAST = r"[A-Za-z0-9+/=_-]{16,}", 16
#: words before and after a candidate that describe it
BEFORE, AFTER = 3, 2
#: labelled findings of each kind that a forest is trained on at most
TRAINED_ON = 10_000
#: documents-wide count from which a word counts as one of the dictionary
FREQUENT = 20
TREES, DEPTH, SEED = 25, 6, 8

# Fixed lists of cues.
SECRET_WORDS = "token secret password passwd passphrase pwd apikey api_key access_key private_key credential credentials auth authorization bearer".split()
OTHER_WORDS = "sha sha1 sha256 md5 commit checksum digest hash uuid guid revision integrity fingerprint etag".split()
TEST_PATH = r"(?i)(^|[^a-z])(tests?|examples?|samples?|fixtures?|mocks?|docs?)([^a-z]|$)"
PLACEHOLDER = r"(?i)example|placeholder|changeme|dummy|your[-_]|x{6,}|0{8,}|1234567"

FEATURES = [
    "length", "digits", "upper", "lower", "symbols", "hexadecimal", "distinct", "switches", "transitions", "dictionary", "assigned", "quoted", "secret_word", "other_word", "test_path",
    "slashes", "placeholder",
]


def find_candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = None) -> DataFrame:
    """(doc_id, word_no, path, finding, word, before, after) of every candidate, of every row.

    Words are runs without blanks; word_no counts from 0. A word may hold several candidates. Null and empty texts have none. Other columns are not read.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"), (F.col(f"`{path_column}`").cast("string") if path_column else F.lit(None).cast("string")).alias("path")
    ).where(F.rlike("text", F.lit(CANDIDATE)))
    rows = once(rows, F.split(F.trim(F.regexp_replace("text", r"[\x09-\x0D]", " ")), " +"), "words").drop("text")
    words = F.col("words")
    holds = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (F.length(F.get(words, i)) >= LEAST) & F.rlike(F.get(words, i), F.lit(CANDIDATE)))

    def place(i: Column) -> Column:
        start = F.greatest(i - BEFORE, F.lit(0))
        return F.struct(
            i.cast("bigint").alias("word_no"), F.get(words, i).alias("word"), F.array_join(F.slice(words, start + 1, i - start), " ").alias("before"), F.array_join(F.slice(words, i + 2, AFTER), " ").alias("after")
        )

    found = rows.select("doc_id", "path", F.explode(F.transform(holds, place)).alias("place")).select("doc_id", "path", "place.*")
    return found.select("doc_id", "word_no", "path", F.explode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))).alias("finding"), "word", "before", "after")


def dictionary(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Words of 3 to 24 letters that occur FREQUENT times or more in all texts, in lower case."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(f"`{text_column}`").cast("string")), F.lit("[a-z]{3,24}"), F.lit(0))).alias("part"))
    return words.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT).select("part")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("finding", pattern, "")) / F.length("finding")


def _any(words: list[str], text: Column) -> Column:
    return F.rlike(F.lower(text), F.lit(r"(^|[^a-z0-9])(" + "|".join(words) + r")([^a-z0-9]|$)")).cast("double")


def _pairs() -> Column:
    """Pairs of neighbouring characters of a finding, with digits as one and upper case as another character."""
    plain = F.regexp_replace(F.regexp_replace("finding", "[0-9]", "0"), "[A-Z]", "A")
    return F.transform(F.sequence(F.lit(1), F.length("finding") - 1), lambda i: F.substring(plain, i, F.lit(2)))


def _describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add all features but ``transitions``, which labels decide."""
    parts = found.select("finding").distinct().select("finding", F.explode(F.regexp_extract_all(F.lower(F.regexp_replace("finding", "([a-z])([A-Z])", "$1 $2")), F.lit("[a-z]{3,24}"), F.lit(0))).alias("part"))
    covered = parts.join(words, "part").groupBy("finding").agg(F.sum(F.length("part")).alias("_covered"))
    rows = found.join(covered, "finding", "left")
    beside = F.concat_ws(" ", "before", F.col("word"))
    only = F.array_distinct(F.split("finding", ""))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("finding", "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    return rows.select(
        "*", F.length("finding").cast("double").alias("length"), _share("[^0-9]").alias("digits"), _share("[^A-Z]").alias("upper"), _share("[^a-z]").alias("lower"), _share("[A-Za-z0-9]").alias("symbols"),
        F.rlike("finding", F.lit("^([0-9a-f]+|[0-9A-F]+)$")).cast("double").alias("hexadecimal"), (F.size(only) / F.length("finding")).alias("distinct"), (F.length(kinds) / F.length("finding")).alias("switches"),
        (F.coalesce("_covered", F.lit(0)) / F.length("finding")).alias("dictionary"),
        F.rlike(F.concat_ws(" ", "before", F.col("word")), F.lit(r"[:=]\s*[\"']?[A-Za-z0-9+/=_-]{16,}")).cast("double").alias("assigned"),
        F.rlike("word", F.lit("[\"'`]")).cast("double").alias("quoted"), _any(SECRET_WORDS, beside).alias("secret_word"), _any(OTHER_WORDS, beside).alias("other_word"),
        F.coalesce(F.rlike("path", F.lit(TEST_PATH)).cast("double"), F.lit(0.0)).alias("test_path"), _share("[^/]").alias("slashes"),
        F.rlike("finding", F.lit(PLACEHOLDER)).cast("double").alias("placeholder"),
    ).drop("_covered")


class Scanner:
    """A trained forest with the log-odds of character pairs and the dictionary that its features need. ``forest`` is None where the labels were of one kind only."""

    def __init__(self, forest: RandomForestClassificationModel | None, odds: DataFrame, words: DataFrame):
        self.forest, self.odds, self.words = forest, odds, words

    def _transitions(self, described: DataFrame) -> DataFrame:
        """Add ``transitions``, the mean log-odds of a finding's character pairs."""
        pairs = described.select("finding").distinct().select("finding", F.explode(_pairs()).alias("pair")).join(self.odds, "pair", "left")
        mean = pairs.groupBy("finding").agg(F.avg(F.coalesce("odds", F.lit(0.0))).alias("transitions"))
        return described.join(mean, "finding")

    def score(self, found: DataFrame) -> DataFrame:
        """The candidates with ``probability`` of being a secret; null where the scanner has no forest."""
        columns = found.columns
        if self.forest is None:
            return found.withColumn("probability", F.lit(None).cast("double"))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(self._transitions(_describe(found, self.words)))
        return self.forest.transform(rows).select(*columns, vector_to_array("_probability")[1].alias("probability"))


def train(findings: DataFrame, words: DataFrame) -> Scanner:
    """Train from labelled findings: candidates as ``find_candidates`` gives them, with a column ``label`` (1 secret, 0 not; null is left out).

    At most TRAINED_ON findings of each label are used, those of least hash, so the forest does not depend on the order or the number of tasks.
    """
    work = Workspace(findings.sparkSession)
    place = F.xxhash64("finding", "before", "after", "doc_id", "word_no")
    kinds = [findings.where(F.col("label") == k).withColumn("_place", place).orderBy("_place", "finding").limit(TRAINED_ON) for k in (0, 1)]
    sample, _ = work.materialize(kinds[0].unionByName(kinds[1]).drop("_place"), "labelled")
    pairs = sample.select("label", F.explode(_pairs()).alias("pair")).groupBy("pair").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
    sums = sample.agg(F.sum(F.col("label") * F.length("finding")), F.sum((1 - F.col("label")) * F.length("finding"))).first()
    if not sums[0] or not sums[1]:
        return Scanner(None, pairs, words)
    odds = F.log((F.col("p") + 0.5) / F.lit(float(sums[0]))) - F.log((F.col("q") + 0.5) / F.lit(float(sums[1])))
    scanner = Scanner(None, work.materialize(pairs.select("pair", odds.alias("odds")), "odds")[0], words)
    rows = scanner._transitions(_describe(sample, words))
    rows, _ = work.materialize(rows.select(F.col("label").cast("double").alias("label"), *FEATURES, place.alias("_place")), "described")
    forest = RandomForestClassifier(labelCol="label", featuresCol="_features", probabilityCol="_probability", numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64)
    described = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows.coalesce(1).sortWithinPartitions("_place"))  # TRAINED_ON rows of each label
    # the stored forest, without the summary of its training that the fitted one would take to every task
    forest.fit(described.select("label", "_features")).write().save(f"{work.root}/forest")
    scanner.forest = RandomForestClassificationModel.load(f"{work.root}/forest")
    return scanner


def scan(docs: DataFrame, scanner: Scanner, least: float = 0.5, **columns) -> DataFrame:
    """(doc_id, word_no, path, finding, probability) of the candidates that are secrets by the forest; all candidates where it has none to ask."""
    scored = scanner.score(find_candidates(docs, **columns))
    return scored.where(F.col("probability").isNull() | (F.col("probability") >= least)).select("doc_id", "word_no", "path", "finding", "probability")


def rule_label() -> Column:
    """The label of a finding where nobody has labelled any: a value without dictionary look, of both letters and digits, that is assigned to a name for secrets."""
    named = F.rlike(F.lower(F.concat_ws(" ", "before", F.col("word"))), F.lit("(" + "|".join(SECRET_WORDS) + r")[\"']?\s*[:=]\s*[\"']?[a-z0-9+/=_-]{16,}"))
    mixed = F.rlike("finding", F.lit("[0-9]")) & F.rlike("finding", F.lit("[A-Za-z]")) & ~F.rlike("finding", F.lit(PLACEHOLDER))
    return (named & mixed).cast("int")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, by a forest from findings in half of them. The tables have no labels for findings, so ``rule_label`` gives them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words, _ = Workspace(spark).materialize(dictionary(docs), "dictionary")
    found = find_candidates(docs.where(fold(F.col("doc_id"), 2) == 0), path_column="source")
    scanner = train(found.withColumn("label", rule_label()), words)
    return scan(docs, scanner, path_column="source").select("doc_id", "word_no", F.col("path").alias("source"), "finding", F.round("probability", 6).alias("probability"))
