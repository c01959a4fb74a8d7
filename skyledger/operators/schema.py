"""Learning the property columns of a catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.crawl import inherited
from skyledger.functions.json import last_of_each, lenient, text_of

# Spark types of the property classes; anything else is JSON text.
TYPES = {
    "boolean": T.BooleanType(),
    "bigint": T.LongType(),
    "decimal": T.DecimalType(20, 0),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "json": T.StringType(),
}


def property_type(v: Column) -> Column:
    """Class of a JSON value; an integer beyond 64 bits is ``decimal``, arrays and objects are ``json``, JSON null is ``null``."""
    s = F.schema_of_variant(v)
    return (
        F.when(s == "BOOLEAN", "boolean")
        .when(s == "BIGINT", "bigint")
        .when(s.rlike(r"^DECIMAL\((19|20),0\)"), "decimal")
        .when((s == "DOUBLE") | (s == "FLOAT") | s.startswith("DECIMAL"), "double")
        .when(s == "STRING", "string")
        .when(s == "VOID", "null")
        .otherwise("json")
    )


def property_fields(feature: Column) -> Column:
    """array<struct<name, type>> of a feature's properties in text order; NULL when they are no object."""
    entries = F.map_entries(last_of_each(F.from_json(feature, "properties MAP<STRING,VARIANT>")["properties"]))
    return F.transform(entries, lambda e: F.struct(e["key"].alias("name"), property_type(e["value"]).alias("type")))


def _seen(items_raw: DataFrame) -> DataFrame:
    """(name, type, page_pos, dfs_path, pos): where each property of each class appears first.

    Features of one kind share one list of properties, so they are grouped by that list before it is exploded: what is
    sorted and shuffled is one small row per feature and task, not one per property.
    """
    fields = property_fields(F.col("feature")) if "fields" not in items_raw.columns else F.col("fields")
    lists = lenient(items_raw).select(fields.alias("fields"), F.struct("page_pos", "dfs_path").alias("place"))
    lists = lists.groupBy("fields").agg(F.min("place").alias("place"))
    rows = lists.select("place", F.posexplode("fields").alias("pos", "f"))
    return rows.select("f.name", "f.type", F.struct("place.page_pos", "place.dfs_path", "pos").alias("place"))


def property_names(items_raw: DataFrame) -> DataFrame:
    """(name, ordinal): distinct property names in order of first appearance."""
    names = _seen(items_raw).groupBy("name").agg(F.min("place").alias("place"))
    return _numbered(names).select("ordinal", "name")


def _numbered(columns: DataFrame) -> DataFrame:
    # one row per column of the table
    return columns.withColumn("ordinal", F.row_number().over(Window.orderBy("place", "name")) - 1)


def property_types(items_raw: DataFrame) -> DataFrame:
    """(name, type, n): how many features hold each property with each class of value."""
    fields = lenient(items_raw).select(property_fields(F.col("feature")).alias("fields")).groupBy("fields").agg(F.count(F.lit(1)).alias("n"))
    rows = fields.select(F.explode("fields").alias("f"), "n")
    return rows.groupBy(F.col("f.name").alias("name"), F.col("f.type").alias("type")).agg(F.sum("n").alias("n"))


def merge_types(types: Column) -> Column:
    """One class for several: numbers widen, anything else mixed becomes JSON text, null says nothing."""
    t = F.array_remove(types, "null")
    numbers = F.size(F.array_except(t, F.array(F.lit("bigint"), F.lit("decimal"), F.lit("double")))) == 0
    widest = F.when(F.array_contains(t, "double"), "double").when(F.array_contains(t, "decimal"), "decimal").otherwise("bigint")
    return F.when(F.size(t) == 0, "json").when(F.size(t) == 1, F.get(t, F.lit(0))).when(numbers, widest).otherwise("json")


def sample_items(items_raw: DataFrame) -> DataFrame:
    """The items a sampling reader looks at: the first item link of each document, the first object of each page, and of these
    the first per item type (catalog and collection)."""
    own = text_of(F.from_json("feature", "collection VARIANT")["collection"])
    typed = lenient(items_raw).where("sampled").withColumns(inherited(own))
    row = F.struct(*items_raw.columns)
    first = typed.groupBy("catalog", "collection").agg(F.min_by(row, F.struct("page_pos", "dfs_path")).alias("r"))
    return first.select(*[F.col(f"r.{c}").alias(c) if c not in ("catalog", "collection") else F.col(c) for c in items_raw.columns])


def merge_schema(items_raw: DataFrame, mode: str = "all") -> DataFrame:
    """(ordinal, name, type): the property columns. ``all`` looks at every item and widens, ``first_item`` takes the first type
    seen in the sampled items."""
    if mode == "first_item":
        columns = _seen(sample_items(items_raw)).groupBy("name").agg(F.min_by("type", "place").alias("type"), F.min("place").alias("place"))
        merged = F.when(F.col("type") == "null", "json").otherwise(F.col("type"))
    elif mode == "all":
        columns = _seen(items_raw).groupBy("name").agg(F.collect_set("type").alias("types"), F.min("place").alias("place"))
        merged = merge_types(F.array_sort("types"))
    else:
        raise ValueError("mode must be 'all' or 'first_item'")
    return _numbered(columns.select("name", merged.alias("type"), "place")).select("ordinal", "name", "type")


def infer_schema(items_raw: DataFrame, mode: str = "all") -> T.StructType:
    """The property columns as a StructType. One job; only names and classes reach the driver."""
    rows = merge_schema(items_raw, mode).orderBy("ordinal").collect()
    return T.StructType([T.StructField(r["name"], TYPES[r["type"]], metadata={"class": r["type"]}) for r in rows])
