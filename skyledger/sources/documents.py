"""Landed catalog documents: reading, checking and telling their kinds apart.

``documents`` everywhere means a DataFrame (doc_uri STRING, body STRING), one row per JSON document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import no_strings
from skyledger.functions.json import is_object, lenient, repeats_keys, text_of


#: JSON files by their suffix, in any case
JSON_FILES = "*.{[jJ][sS][oO][nN],[gG][eE][oO][jJ][sS][oO][nN]}"


def file_address(address: Column) -> Column:
    """The address that links spell: Spark writes blanks and the like in file names as %20, and local files with one slash or three."""
    plain = F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:///")


def read_documents(spark: SparkSession, path: str, pattern: str = JSON_FILES) -> DataFrame:
    """One row per JSON file below ``path``, whole text; the address is the file's own."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    return files.select(file_address(F.col("_metadata.file_path")).alias("doc_uri"), F.col("value").alias("body"))


def document_kind(body: Column) -> Column:
    """The document's ``type`` when it is a string, else NULL. One pass over the text, other members are skipped."""
    return text_of(F.from_json(body, "type VARIANT")["type"])


def with_kind(documents: DataFrame) -> DataFrame:
    return lenient(documents).withColumn("kind", document_kind(F.col("body")))


def document_problem(body: Column) -> Column:
    """Why a document cannot be read, NULL when it can. A wrapping array makes text after the root value an error too."""
    wrapped = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<variant>")
    root = F.get(wrapped, F.lit(0))
    kind = F.try_variant_get(root, "$.type", "variant")
    return (
        F.when(body.isNull() | (F.trim(body) == ""), "empty document")
        .when(wrapped.isNull() | (F.size(wrapped) != 1) | root.isNull(), "unparsable document")
        .when(~is_object(root) | (F.coalesce(text_of(kind), F.lit("")) == ""), "missing 'type' field")
    )


def repeated_key(body: Column) -> Column:
    """Whether the document repeats a key: one of its own members, of a link, of ``properties``, of ``assets`` or of one asset."""
    parts = F.from_json(body, "links ARRAY<STRING>, properties STRING, assets STRING")
    assets = F.map_values(F.from_json(parts["assets"], "map<string,string>"))
    objects = F.concat(F.array(body, parts["properties"], parts["assets"]), F.coalesce(parts["links"], no_strings()), F.coalesce(assets, no_strings()))
    return F.exists(F.filter(objects, lambda o: F.coalesce(F.startswith(o, F.lit("{")), F.lit(False))), repeats_keys)


def validate(documents: DataFrame, on_error: str = "fail") -> DataFrame:
    """Check every document: ``fail`` raises at the first bad one, ``drop`` keeps the good ones, ``report`` lists the bad ones.

    A repeated key makes no document bad, as readers take the last value; ``report`` lists it all the same, as "repeated key".
    """
    checked = lenient(documents).withColumn("problem", document_problem(F.col("body")))
    if on_error == "report":
        noted = F.coalesce("problem", F.when(repeated_key(F.col("body")), "repeated key"))
        return checked.withColumn("problem", noted).where("problem IS NOT NULL").select("doc_uri", "problem")
    if on_error == "drop":
        return checked.where("problem IS NULL").select("doc_uri", "body")
    if on_error != "fail":
        raise ValueError("on_error must be 'fail', 'drop' or 'report'")
    failed = F.raise_error(F.concat(F.col("problem"), F.lit(" in '"), F.col("doc_uri"), F.lit("'")))
    return checked.where(F.when(F.col("problem").isNull(), True).otherwise(failed.cast("boolean"))).select("doc_uri", "body")
