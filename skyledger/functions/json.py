"""Column helpers on JSON text and variants. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import let, no_strings
from skyledger.types import ASSET, BBOX


def lenient(rows: DataFrame) -> DataFrame:
    """Read JSON objects that repeat a key: the last value counts, as in every typed column. Without this setting of the session Spark gives
    NULL for the whole value that holds such an object."""
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return rows


def last_of_each(values: Column) -> Column:
    """A map without repeated keys, which JSON may have and Spark's parser keeps: the last entry of a key stays."""

    def once_each(m):
        keys = F.map_keys(m)
        kept = F.filter(F.map_entries(m), lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), m).otherwise(F.map_from_entries(kept))

    return let(values, once_each)


def repeats_keys(json: Column) -> Column:
    """Whether the object of this JSON text repeats one of its keys."""
    return let(F.map_keys(F.from_json(json, "map<string,string>")), lambda keys: F.coalesce(F.size(F.array_distinct(keys)) < F.size(keys), F.lit(False)))


def member(v: Column, name: str) -> Column:
    """Member of a variant object as a variant; NULL when absent or when ``v`` is no object."""
    return F.try_variant_get(v, f"$['{name}']", "variant")


def text_of(v: Column) -> Column:
    """The text of a JSON string; NULL for every other JSON value."""
    return F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))


def member_text(v: Column, name: str) -> Column:
    return text_of(member(v, name))


def is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def json_text(json: Column, path: str) -> Column:
    """Minified text of a nested value with its keys in document order; strings come without quotes, JSON null is NULL."""
    return F.get_json_object(json, path)


# -- arrays and maps of variants, as one pass over a feature delivers them ---------------------------------------------


def bbox_struct(json: Column) -> Column:
    """Array text of four or more numbers -> struct(minx, miny, maxx, maxy); six numbers carry heights at positions 2 and 5.
    NULL when one of the corners is no number."""

    def corners(n):
        upper = F.when((F.size(n) == 6) & F.get(n, F.lit(4)).isNotNull() & F.get(n, F.lit(5)).isNotNull(), 4).otherwise(3)
        at = [F.lit(0), F.lit(1), upper - 1, upper]
        return let(F.array(*[F.get(n, i) for i in at]), lambda c: F.when(~F.exists(c, lambda x: x.isNull()), box(c)))

    def box(c):
        return F.struct(*[F.get(c, F.lit(i)).alias(name) for i, name in enumerate(BBOX.names)])

    inner = F.substr(json, F.lit(2), F.length(json) - 2)
    numbers = F.transform(F.split(inner, ","), lambda t: t.try_cast("double"))
    return F.when(json.startswith("["), let(numbers, corners))


def strings_from_variants(values: Column) -> Column:
    return F.array_compact(F.transform(values, text_of))


def links_from_variants(links: Column) -> Column:
    def blank(v, name):
        return F.coalesce(member_text(v, name), F.lit("")).alias(name)

    kept = F.filter(links, lambda v: member_text(v, "href").isNotNull() & member_text(v, "rel").isNotNull())
    return F.transform(kept, lambda v: F.struct(blank(v, "href"), blank(v, "type"), blank(v, "title"), blank(v, "rel")))


def assets_from_variants(assets: Column) -> Column:
    def asset(_, v):
        roles = strings_from_variants(F.try_variant_get(v, "$.roles", "array<variant>"))
        fields = [F.coalesce(member_text(v, n), F.lit("")).alias(n) for n in ASSET.names[:4]]
        return F.struct(*fields, F.coalesce(roles, no_strings()).alias("roles"))

    return F.transform_values(F.map_filter(last_of_each(assets), lambda _, v: member_text(v, "href").isNotNull()), asset)


# -- the same on JSON text ---------------------------------------------------------------------------------------------


def string_list(json: Column) -> Column:
    return strings_from_variants(F.from_json(json, "array<variant>"))


def link_structs(json: Column) -> Column:
    return links_from_variants(F.from_json(json, "array<variant>"))


def asset_map(json: Column) -> Column:
    return assets_from_variants(F.from_json(json, "map<string,variant>"))
