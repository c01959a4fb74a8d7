"""Shaping features into the item table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.columns import let, once
from skyledger.functions.geometry import GEOJSON_PARTS, wkt_of_parts
from skyledger.functions.json import assets_from_variants, bbox_struct, lenient, links_from_variants, strings_from_variants, text_of
from skyledger.operators.crawl import inherited
from skyledger.types import FIXED_COLUMNS, LINK

# Members of a feature that must exist with the right JSON kind, in the order they are looked for.
REQUIRED = ["id", "geometry", "bbox", "stac_extensions", "links", "assets", "properties"]

_MEMBERS = {
    "id": "VARIANT",
    "collection": "VARIANT",
    "geometry": f"STRUCT<{GEOJSON_PARTS}>",
    "bbox": "STRING",
    "stac_extensions": "ARRAY<VARIANT>",
    "links": "ARRAY<VARIANT>",
    "assets": "MAP<STRING,VARIANT>",
}


def output_names(schema: T.StructType) -> list[str]:
    """Column name of each property. A fixed column keeps its name; a property that would repeat one becomes ``properties.<name>``.

    Column names differ by more than case, property names need not.
    """
    taken, names = set(FIXED_COLUMNS), []
    for field in schema.fields:
        name = field.name
        while name.lower() in taken:
            name = f"properties.{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def _layers(schema: T.StructType) -> list[T.StructType]:
    """The schema cut so that no layer holds two names that differ by case only."""
    layers: list[dict[str, T.StructField]] = []
    for field in schema.fields:
        layer = next((l for l in layers if field.name.lower() not in l), None)
        if layer is None:
            layer = {}
            layers.append(layer)
        layer[field.name.lower()] = field
    return [T.StructType([T.StructField(f.name, f.dataType) for f in l.values()]) for l in layers] or [T.StructType([])]


def parse_features(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``_f``, all members of ``feature`` with the properties typed: one pass over the text, whatever the number of columns."""
    first, *more = _layers(schema)
    members = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in _MEMBERS.items()))
    out = once(lenient(rows), F.from_json("feature", members.add("properties", first)), "_f")
    for i, layer in enumerate(more, 1):
        out = once(out, F.from_json("feature", T.StructType().add("properties", layer)), f"_f{i}")
    return out


def _missing_names() -> list[Column]:
    """Per required member its name where a parsed feature lacks it, else NULL."""

    def gone(name: str) -> Column:
        value = F.col(f"_f.{name}")
        if name == "id":
            value = text_of(value)
        if name == "bbox":
            value = F.when(value.startswith("["), value)
        return F.when(value.isNull(), F.lit(name))

    return [gone(n) for n in REQUIRED]


def require_fields(items_raw: DataFrame, strict: bool = True) -> DataFrame:
    """``strict``: raise for a feature that lacks a required member. Else: the reject report (doc_uri, feature, missing)."""
    parsed = parse_features(items_raw, T.StructType([])).withColumn("missing", F.array_compact(F.array(*_missing_names())))
    if not strict:
        return parsed.where(F.size("missing") > 0).select("doc_uri", "feature", "missing")
    fault = F.format_string("member '%s' is missing", F.get("missing", F.lit(0)))
    return _raise(parsed.withColumn("_fault", F.when(F.size("missing") > 0, fault))).select(*items_raw.columns)


def _error(fault: str) -> Column:
    # the page number comes from the closure: the test stays above its join and spares documents that are not reached
    return F.raise_error(F.format_string("%s in the feature '%s' of page %s", fault, "doc_uri", F.col("page_pos").cast("string")))


def _raise(rows: DataFrame) -> DataFrame:
    return rows.where(F.when(F.col("_fault").isNull(), True).otherwise(_error("_fault").cast("boolean")))


def promote(schema: T.StructType) -> list[Column]:
    """The typed value of each property of the schema, from a parsed feature; NULL where the feature lacks it."""
    layers, columns = [{f.name for f in layer.fields} for layer in _layers(schema)], []
    for field in schema.fields:
        layer = next(i for i, names in enumerate(layers) if field.name in names)
        columns.append(F.col(f"_f{layer or ''}")["properties"].getField(field.name))
    return columns


def shape_features(rows: DataFrame, schema: T.StructType, wkt_digits: int | None = None, geometry: bool = True) -> DataFrame:
    """Add the columns of the item table to features, under neutral names and without raising: ``_own`` (collection), ``_c<name>``
    for the fixed columns, ``_p<number>`` for the properties and ``_fault``, why the feature is no valid item. ``_cgeometry`` is a struct of wkt and what is wrong with the geometry.

    Without ``geometry`` the footprint is not converted: it must be there, but is NULL in the result and may be invalid."""
    parsed = parse_features(rows, schema)
    wkt = wkt_of_parts(F.col("_f.geometry"), wkt_digits) if geometry else F.lit(None).cast("string")
    parsed = once(parsed, bbox_struct(F.col("_f.bbox")), "_b")
    fault = F.concat(F.lit("member '"), F.coalesce(*_missing_names()), F.lit("' is missing"))
    # the footprint is a plain column, so that it goes where nothing reads it; what is wrong with it is said where it is read
    not_one = F.concat(F.lit("not a GeoJSON geometry "), F.to_json("_f.geometry"))
    footprint = let(wkt, lambda w: F.struct(w.alias("wkt"), F.when(w.isNull() & F.col("feature").isNotNull() & F.lit(geometry), not_one).alias("wrong")))
    return parsed.select(
        *rows.columns,
        text_of(F.col("_f.collection")).alias("_own"),
        text_of(F.col("_f.id")).alias("_cid"),
        footprint.alias("_cgeometry"),
        F.col("_b").alias("_cbbox"),
        strings_from_variants(F.col("_f.stac_extensions")).alias("_cstac_extensions"),
        links_from_variants(F.col("_f.links")).alias("_clinks"),
        assets_from_variants(F.col("_f.assets")).alias("_cassets"),
        *[c.alias(f"_p{i}") for i, c in enumerate(promote(schema))],
        F.when(F.col("feature").isNotNull(), fault).alias("_fault"),
    )


def pick_fixed(fixed) -> list[str]:
    """These of the fixed columns, in the order of the table; all by default."""
    unknown = set(fixed or ()) - set(FIXED_COLUMNS)
    if unknown:
        raise ValueError(f"no fixed columns: {sorted(unknown)}")
    return [c for c in FIXED_COLUMNS if fixed is None or c in fixed]


def finish_items(shaped: DataFrame, schema: T.StructType, strict: bool = True, keep=(), fixed=None) -> DataFrame:
    """The item table of shaped features that know their inherited ids."""
    if strict:
        shaped = _raise(shaped)
    columns = dict(inherited(F.col("_own")))
    for name in FIXED_COLUMNS[2:]:
        columns[name] = F.col(f"_c{name}")
    columns["geometry"] = F.col("_cgeometry.wkt")
    if strict:
        columns["geometry"] = F.coalesce(columns["geometry"], F.when(F.col("_cgeometry.wrong").isNotNull(), _error("_cgeometry.wrong").cast("string")))
    if not strict:
        for name, element in (("stac_extensions", "string"), ("links", LINK.simpleString())):
            columns[name] = F.coalesce(columns[name], F.expr(f"cast(array() as array<{element}>)"))
    properties = [
        F.col(f"_p{i}").alias(name, metadata=field.metadata)
        for i, (field, name) in enumerate(zip(schema.fields, output_names(schema)))
    ]
    return shaped.select(*[columns[n].alias(n) for n in pick_fixed(fixed)], *properties, *keep)


def pick_columns(schema: T.StructType, columns) -> T.StructType:
    """The part of the schema behind these column names."""
    if columns is None:
        return schema
    wanted = set(columns)
    return T.StructType([f for f, n in zip(schema.fields, output_names(schema)) if n in wanted])


def items(
    items_raw: DataFrame, schema: T.StructType, strict: bool = True, wkt_digits: int | None = None, columns=None, keep=(), fixed=None,
) -> DataFrame:
    """The item table: catalog, collection, id, geometry, bbox, stac_extensions, links, assets, then one column per property.

    ``columns`` names the property columns to parse, ``fixed`` the fixed columns to give (all by default); ``keep`` names columns of
    ``items_raw`` to carry along. Where ``fixed`` leaves out the geometry, footprints are not converted and not checked beyond their presence.
    A property that is not in the schema is dropped, one that a feature lacks is NULL. ``strict`` raises for features that lack
    a required member, and where the geometry is read for those whose geometry is invalid; otherwise what is absent becomes NULL or an empty list.
    """
    schema = pick_columns(schema, columns)
    geometry = "geometry" in pick_fixed(fixed)
    return finish_items(shape_features(items_raw, schema, wkt_digits, geometry), schema, strict, keep, fixed)
