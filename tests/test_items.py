import json

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import skyledger as sky
from skyledger.functions import json as js
from tests.conftest import feature


@pytest.fixture(scope="module")
def catalog(documents):
    """One collection that links to the given features in order."""

    def build(*features):
        docs = {"m:/c.json": {"type": "Collection", "id": "col", "links": [{"rel": "item", "href": f"i{n}.json"} for n in range(len(features))]}}
        docs |= {f"m:/i{n}.json": f for n, f in enumerate(features)}
        return documents(docs)

    return build


def types(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_infer_schema_modes(catalog):
    docs = catalog(
        feature("a", properties={"n": 1, "s": "x", "o": {"b": 1}, "z": None, "m": 1, "big": 1}),
        feature("b", properties={"late": True, "n": 2.5, "s": 5, "o": [1], "m": "x", "z": None, "big": 12345678901234567890}),
    )
    raw = sky.crawl(docs, "m:/c.json")
    assert types(sky.infer_schema(raw)) == [
        ("n", "double"), ("s", "string"), ("o", "string"), ("z", "string"), ("m", "string"), ("big", "decimal(20,0)"), ("late", "boolean")]
    # only the first item of a link list is sampled
    assert types(sky.infer_schema(raw, "first_item")) == [
        ("n", "bigint"), ("s", "string"), ("o", "string"), ("z", "string"), ("m", "bigint"), ("big", "bigint")]
    rows = sky.read(docs, "m:/c.json").orderBy("id").collect()
    assert [rows[0][c] for c in ("n", "s", "o", "z", "m", "late")] == [1.0, "x", '{"b":1}', None, "1", None]
    assert [rows[1][c] for c in ("n", "s", "o", "z", "m", "late")] == [2.5, "5", "[1]", None, "x", True]
    assert int(rows[1]["big"]) == 12345678901234567890
    with pytest.raises(ValueError):
        sky.infer_schema(raw, "some")


def test_sample_takes_first_object_of_a_page_and_first_of_a_type(documents):
    docs = documents({
        "m:/c.json": {"type": "Catalog", "id": "c", "links": [{"rel": "child", "href": "p.json"}, {"rel": "item", "href": "i.json"}, {"rel": "item", "href": "j.json"}]},
        "m:/p.json": {"type": "FeatureCollection", "features": [1, feature("p0", properties={"a": 1}), feature("p1", properties={"b": 1})], "links": [{"rel": "next", "href": "q.json"}]},
        "m:/q.json": {"type": "FeatureCollection", "features": [feature("q0", properties={"d": 1})]},
        "m:/i.json": feature("i", properties={"a": "not first of its type", "e": 1}), "m:/j.json": feature("j", "other", properties={"f": 1}),
    })
    raw = sky.crawl(docs, "m:/c.json")
    assert [f.name for f in sky.infer_schema(raw, "first_item").fields] == ["a"]
    assert [f.name for f in sky.infer_schema(raw).fields] == ["a", "b", "e", "f", "d"]


def test_property_names_keep_text_order(catalog):
    raw = sky.crawl(catalog(feature("a", properties={"z": 1, "a": 2}), feature("b", properties={"m": 1, "a": 2})), "m:/c.json")
    assert [r["name"] for r in sky.property_names(raw).orderBy("ordinal").collect()] == ["z", "a", "m"]
    assert sorted(tuple(r) for r in sky.property_types(raw).collect()) == [("a", "bigint", 2), ("m", "bigint", 1), ("z", "bigint", 1)]


def test_fixed_columns_come_first_and_names_stay_apart(catalog):
    items = sky.read(catalog(feature("a", properties={"id": "p", "Case": 1, "case": "two", "eo:x.y": 3, "feature": 4, "page_pos": 5})), "m:/c.json")
    assert items.columns == ["catalog", "collection", "id", "geometry", "bbox", "stac_extensions", "links", "assets",
                             "properties.id", "Case", "properties.case", "eo:x.y", "feature", "page_pos"]
    row = items.first()
    assert (row["id"], row["properties.id"], row["Case"], row["properties.case"], row["eo:x.y"], row["feature"], row["page_pos"]) == ("a", "p", 1, "two", 3, 4, 5)


def test_types_of_the_fixed_columns(catalog):
    items = sky.read(catalog(feature("a", links=[{"rel": "r", "href": "h"}], assets={"x": {"href": "h"}}, stac_extensions=["e", 5])), "m:/c.json")

    def plain(t):
        return t.simpleString()

    assert plain(items.schema["bbox"].dataType) == plain(sky.BBOX)
    assert plain(items.schema["links"].dataType.elementType) == plain(sky.LINK)
    assert plain(items.schema["assets"].dataType.valueType) == plain(sky.ASSET)
    row = items.first()
    assert row["stac_extensions"] == ["e"]
    assert [tuple(l) for l in row["links"]] == [("h", "", "", "r")]
    assert tuple(row["assets"]["x"]) == ("h", "", "", "", [])


@pytest.mark.parametrize("change, missing", [
    ({"id": None}, "id"), ({"id": 5}, "id"), ({"geometry": None}, "geometry"), ({"geometry": [1]}, "geometry"), ({"bbox": None}, "bbox"),
    ({"bbox": {"a": 1}}, "bbox"), ({"stac_extensions": None}, "stac_extensions"), ({"links": {}}, "links"), ({"assets": []}, "assets"),
    ({"properties": None}, "properties"), ({"properties": 7}, "properties"), ({"id": None, "links": None}, "id,links"),
])
def test_required_members(catalog, change, missing):
    bad = feature("a", properties={"k": 1}) | change
    bad = {k: v for k, v in bad.items() if v is not None}
    raw = sky.crawl(catalog(bad, feature("b")), "m:/c.json")
    report = sky.require_fields(raw, strict=False).collect()
    assert [(r["doc_uri"], ",".join(r["missing"])) for r in report] == [("m:/i0.json", missing)]
    with pytest.raises(SparkRuntimeException, match=f"member '{missing.split(',')[0]}' is missing in the feature 'm:/i0.json'"):
        sky.require_fields(raw).collect()
    schema = T.StructType([T.StructField("k", T.LongType())])
    with pytest.raises(SparkRuntimeException, match="is missing"):
        sky.items(raw, schema).select("id").collect()
    assert sky.items(raw, schema, strict=False).count() == 2


def test_null_geometry_and_invalid_geometry(catalog):
    docs = catalog(feature("a") | {"geometry": None}, feature("b", geometry={"type": "Point", "coordinates": []}))
    lenient = sky.read(docs, "m:/c.json", strict=False).orderBy("id").collect()
    assert [r["geometry"] for r in lenient] == [None, "POINT EMPTY"]
    with pytest.raises(SparkRuntimeException, match="member 'geometry' is missing"):
        sky.read(docs, "m:/c.json").collect()
    with pytest.raises(SparkRuntimeException, match="not a GeoJSON geometry"):
        sky.read(catalog(feature("b", geometry={"type": "Point", "coordinates": [1]})), "m:/c.json").collect()


@pytest.mark.parametrize("text, box", [
    ("[1,2,3,4]", (1, 2, 3, 4)), ("[1.5,2,3,4.25]", (1.5, 2, 3, 4.25)), ("[1,2,9,3,4,9]", (1, 2, 3, 4)), ("[1,2,3]", None),
    ('[1,2,"3",4]', None), ("[1,2,3,4,5]", (1, 2, 3, 4)), ("[1,null,3,4]", None), ('{"a":1}', None), ("[[1,2],[3,4]]", None), ("[-1e2,0,1E1,2]", (-100, 0, 10, 2)),
])
def test_bbox_struct(spark, text, box):
    got = spark.range(1).select(js.bbox_struct(F.lit(text)).alias("b")).first()["b"]
    assert (tuple(got) if got else None) == box


def test_links_and_assets(spark):
    links = json.dumps([{"href": "h", "rel": "r", "title": 5, "x": 1}, {"href": "h"}, 7, {"rel": "r", "href": 3}, {"rel": "r", "href": "k", "type": "t"}])
    assets = json.dumps({"a": {"href": "h", "roles": ["x", 5, None], "description": "d"}, "b": {"title": "t"}, "c": 5, "d": {"href": "e", "roles": "no"}})
    row = spark.range(1).select(js.link_structs(F.lit(links)).alias("l"), js.asset_map(F.lit(assets)).alias("a"), js.string_list(F.lit('["a",5,null,"b"]')).alias("s")).first()
    assert [tuple(l) for l in row["l"]] == [("h", "", "", "r"), ("k", "t", "", "r")]
    assert {k: tuple(v) for k, v in row["a"].items()} == {"a": ("h", "", "", "d", ["x"]), "d": ("e", "", "", "", [])}
    assert row["s"] == ["a", "b"]


def test_a_filter_does_not_parse_twice(catalog):
    items = sky.read(catalog(feature("a", properties={"v": 1.5}), feature("b", properties={"v": 2.5})), "m:/c.json")
    plan = items.where("v > 2 AND bbox.minx > 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("properties,StructType") <= 1
    assert [r["id"] for r in items.where("v > 2 AND bbox.minx > 1").collect()] == ["b"]


def test_columns_narrow_the_parse(catalog):
    docs = catalog(feature("a", properties={"x": 1, "y": "b"}))
    assert sky.read(docs, "m:/c.json", columns=["y"]).columns[-1] == "y"
    assert len(sky.read(docs, "m:/c.json", columns=[]).columns) == 8
