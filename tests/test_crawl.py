import json

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

import skyledger as sky
from skyledger.functions.uri import is_static, resolve_href
from tests.conftest import feature


def links(*pairs):
    return [{"rel": r, "href": h} for r, h in pairs]


def ids(df):
    return [tuple(r) for r in sky.crawl_order(df).select(F.get_json_object("feature", "$.id"), "catalog", "collection").collect()]


@pytest.mark.parametrize("base, href, target", [
    ("mem:/a/catalog.json", "./r1/catalog.json", "mem:/a/r1/catalog.json"),
    ("mem:/a/r1/n2/collection.json", "../catalog.json", "mem:/a/r1/catalog.json"),
    ("mem:/a/r1/x.json", "../../../y.json", "mem:/y.json"),
    ("./test/data/catalog.json", "./collection.json", "./test/data/collection.json"),
    ("https://h/a/b?x=1/2", "c?p=1/../2", "https://h/a/c?p=1/../2"),
    ("https://h/a", "../../b", "https://h/b"),
    ("a.json", "../b.json", "../b.json"),
    ("/x/y.json", "/z.json", "/z.json"),
    ("/x/y.json", "https://q/z", "https://q/z"),
    ("mem:/a/b/c.json", "d/./e/../f.json", "mem:/a/b/d/f.json"),
])
def test_resolve_href(spark, base, href, target):
    row = spark.range(1).select(resolve_href(F.lit(base), F.lit(href)).alias("t")).first()
    assert row["t"] == target


def test_is_static(spark):
    urls = ["a/b.json", "a/b.GeoJSON", "a/b", "a/b.json?limit=1", "s3://x/y.JSON"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    assert [r[0] for r in df.orderBy("i").select(is_static(F.col("u"))).collect()] == [True, True, False, False, True]


def test_catalog_collection_item(documents):
    """The shape of a minimal catalog: the item names another collection than its parent, and its own name wins."""
    docs = documents({
        "/c/catalog.json": {"type": "Catalog", "id": "examples", "links": links(("root", "./catalog.json"), ("child", "./collection.json"), ("self", "./catalog.json"))},
        "/c/collection.json": {"type": "Collection", "id": "other", "links": links(("parent", "./catalog.json"), ("item", "./item.json"), ("license", "https://x/y.pdf"))},
        "/c/item.json": feature("parcel-17", "harvest-9", properties={"proj:code": "EPSG:25832"}, bbox=[11.25, 46.5, 11.75, 47.125]),
    })
    rows = sky.read(docs, "/c/catalog.json").select("catalog", "collection", "id", "bbox", "`proj:code`").collect()
    assert [(r[0], r[1], r[2], tuple(r[3]), r[4]) for r in rows] == [
        ("examples", "harvest-9", "parcel-17", (11.25, 46.5, 11.75, 47.125), "EPSG:25832")]


def test_ids_order_pages_and_shared_documents(documents):
    page = lambda n, nxt, *more: {"type": "FeatureCollection", "features": [3, feature(f"p{n}"), feature(f"q{n}")], "links": links(*more, *([("next", nxt)] if nxt else []))}
    docs = documents({
        "m:/c.json": {"type": "Catalog", "id": "cat", "links": links(("child", "k/col.json"), ("child", "pages.json"), ("child", "sub.json"))},
        "m:/k/col.json": {"type": "Collection", "id": "col", "links": [5, {"rel": "item"}, *links(("item", "i1.json"), ("item", "../i2.json"))]},
        "m:/sub.json": {"type": "Catalog", "id": "sub", "links": links(("item", "./i2.json"))},
        "m:/k/i1.json": feature("i1"),
        "m:/i2.json": feature("i2", "own"),
        "m:/pages.json": page(0, "./page1.json", ("item", "k/i1.json")),
        "m:/page1.json": page(1, "page2.json"),
        "m:/page2.json": page(2, None, ("item", "i2.json")),
        "m:/not-linked.json": "{broken",
    })
    raw = sky.crawl(docs, "m:/c.json")
    assert ids(raw) == [
        ("i1", "cat", "col"), ("i2", "cat", "col"), ("p0", "cat", None), ("q0", "cat", None), ("i1", "cat", None), ("i2", "sub", None),
        ("p1", "cat", None), ("q1", "cat", None), ("p2", "cat", None), ("q2", "cat", None), ("i2", "cat", None)]
    assert [tuple(r) for r in sky.crawl_order(sky.inherit_ids(raw)).select("catalog", "collection").collect()][:3] == [("cat", "col"), ("cat", "own"), ("cat", "")]
    # a document that no link reaches is never an error, not even in a strict read
    assert sky.read(docs, "m:/c.json").count() == 11


def test_last_next_link_counts_and_circles_end(documents):
    docs = documents({
        "m:/0": {"type": "FeatureCollection", "features": [feature("a")], "links": links(("next", "./nowhere"), ("next", "./1"))},
        "m:/1": {"type": "FeatureCollection", "features": [feature("b")], "links": links(("next", "./2"))},
        "m:/2": {"type": "FeatureCollection", "features": [feature("c")], "links": links(("next", "./1"))},
    })
    pages = sky.follow_pages(docs, "m:/0").orderBy("page_pos").collect()
    assert [(r["page_pos"], r["doc_uri"]) for r in pages] == [(0, "m:/0"), (1, "m:/1"), (2, "m:/2")]


def test_long_chain(spark):
    n = 700
    body = F.concat(F.lit('{"type":"FeatureCollection","numberMatched":%d,"features":[{}],"links":[' % n),
                    F.when(F.col("id") < n - 1, F.concat(F.lit('{"rel":"next","href":"./'), (F.col("id") + 1).cast("string"), F.lit('"}'))).otherwise(""), F.lit("]}"))
    docs = spark.range(n).select(F.concat(F.lit("m:/"), F.col("id").cast("string")).alias("doc_uri"), body.alias("body"))
    pages = sky.follow_pages(docs, "m:/0")
    wrong = pages.where(F.concat(F.lit("m:/"), F.col("page_pos").cast("string")) != F.col("doc_uri"))
    assert pages.count() == n and wrong.count() == 0
    audit = sky.matched_audit(pages).first()
    assert (audit["number_matched"], audit["returned"], audit["percent"], audit["is_large"]) == (n, n, 100.0, False)


def test_links_back_are_cut(documents):
    docs = documents({
        "m:/c.json": {"type": "Catalog", "id": "c", "links": links(("child", "d.json"), ("child", "c.json"))},
        "m:/d.json": {"type": "Catalog", "id": "d", "links": links(("child", "c.json"), ("item", "i.json"))},
        "m:/i.json": feature("i"),
    })
    assert ids(sky.crawl(docs, "m:/c.json")) == [("i", "d", None)]
    assert sorted((r["doc_uri"], r["target_uri"]) for r in sky.cycles(docs, "m:/c.json").collect()) == [("m:/c.json", "m:/c.json"), ("m:/d.json", "m:/c.json")]


def test_missing_and_broken_documents(documents):
    docs = {
        "m:/c.json": {"type": "Catalog", "id": "c", "links": links(("item", "i.json"), ("item", "gone.json"), ("item", "broken.json"))},
        "m:/i.json": feature("i"), "m:/broken.json": '{"id": 1}',
    }
    with pytest.raises(FileNotFoundError, match="gone.json"):
        sky.crawl(documents(docs), "m:/c.json")
    assert [tuple(r) for r in sky.missing_targets(documents(docs), "m:/c.json").collect()] == [("m:/gone.json", "m:/c.json")]
    with pytest.raises(SparkRuntimeException, match="missing 'type' field in the document 'm:/broken.json', linked from 'm:/c.json'"):
        sky.crawl(documents(docs), "m:/c.json", on_missing="drop").collect()
    assert ids(sky.crawl(documents(docs), "m:/c.json", on_missing="drop", on_error="drop")) == [("i", "c", None)]
    with pytest.raises(ValueError):
        sky.crawl(documents(docs), "")


def test_escaped_type_and_unknown_types(documents):
    docs = documents({
        "m:/c.json": r'{"type":"\u0043atalog","id":"c","links":[{"rel":"item","href":"i.json"},{"rel":"child","href":"odd.json"}]}',
        "m:/i.json": feature("i"), "m:/odd.json": {"type": "Thing", "links": links(("item", "i.json"))},
    })
    assert ids(sky.crawl(docs, "m:/c.json")) == [("i", "c", None)]


def test_explode_links(documents):
    docs = documents({"m:/p": {"type": "FeatureCollection", "links": [
        7, {"rel": "next"}, {"href": "x"}, {"rel": "", "href": "x"}, {"rel": "a", "href": 5},
        {"rel": "next", "href": "n", "method": "POST", "merge": True, "headers": {"a": "b", "c": 5}, "body": {"z": 1, "a": [2]}},
        {"rel": "self", "href": "s", "merge": "yes", "body": "text"}]}})
    rows = sky.explode_links(docs).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [
        ("m:/p", 5, "next", "n", "POST", True, {"a": "b"}, '{"z":1,"a":[2]}'), ("m:/p", 6, "self", "s", "GET", False, None, None)]


def test_validate(documents):
    docs = documents({"ok": {"type": "Catalog"}, "blank": "  ", "text": "nope", "cut": '{"type":"Catalog"', "tail": '{"type":"Catalog"} x',
                      "two": '{"type":"Catalog"},{"type":"Catalog"}', "list": '[{"type":"Catalog"}]', "none": {"id": 1}, "number": {"type": 5}, "void": {"type": ""}})
    report = {r["doc_uri"]: r["problem"] for r in sky.validate(docs, "report").collect()}
    missing, unparsable = "missing 'type' field", "unparsable document"
    assert report == {"blank": "empty document", "text": unparsable, "cut": unparsable, "tail": unparsable, "two": unparsable,
                      "list": missing, "none": missing, "number": missing, "void": missing}
    assert [r["doc_uri"] for r in sky.validate(docs, "drop").collect()] == ["ok"]
    with pytest.raises(SparkRuntimeException):
        sky.validate(docs).collect()


def test_read_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "catalog.json").write_text('{"type": "Catalog",\n "id": "c", "links": [{"rel": "item", "href": "./sub/i.geojson"}]}')
    import json
    (tmp_path / "sub" / "i.geojson").write_text(json.dumps(feature("i"), indent=2))
    (tmp_path / "notes.txt").write_text("x")
    (tmp_path / "sub" / "catalog.json").write_text('{"type": "Catalog"}')
    assert sky.read_documents(spark, str(tmp_path)).count() == 3
    items = sky.read_catalog(spark, f"{tmp_path}/catalog.json")
    items.createOrReplaceTempView("catalog_items")
    assert [tuple(r) for r in spark.sql("SELECT catalog, id, bbox.minx FROM catalog_items WHERE bbox.minx > 1").collect()] == [("c", "i", 1.5)]
    with pytest.raises(FileNotFoundError):
        sky.read_catalog(spark, f"{tmp_path}/other.json")
    for bad in ("", "https://host/search?limit=10"):
        with pytest.raises(ValueError):
            sky.read_catalog(spark, bad)


def test_repeated_keys_lose_nothing(spark, documents):
    docs = documents({
        "mem:/catalog.json": '{"type":"Catalog","id":"c","links":[{"rel":"item","href":"a.json"},{"rel":"item","href":"no.json","href":"b.json"},{"rel":"item","href":"c.json"}]}',
        **{f"mem:/{n}.json": feature(n) for n in "abc"},
    })
    assert sorted(r["doc_uri"] for r in sky.crawl(docs, "mem:/catalog.json").collect()) == [f"mem:/{n}.json" for n in "abc"]
    bad = {r["doc_uri"]: r["problem"] for r in sky.validate(docs, "report").collect()}
    assert bad == {"mem:/catalog.json": "repeated key"} and sky.validate(docs).count() == 4


def test_a_mesh_is_walked_once(spark, documents):
    n = 12
    docs = {f"mem:/c{k}.json": {"type": "Catalog", "id": f"c{k}", "links": [{"rel": "child", "href": f"c{j}.json"} for j in range(n)] + [{"rel": "item", "href": f"i{k}.json"}]} for k in range(n)}
    docs |= {f"mem:/i{k}.json": feature(f"i{k}") for k in range(n)}
    found = sky.crawl(documents(docs), "mem:/c0.json").collect()
    assert sorted((r["catalog"], r["doc_uri"]) for r in found) == sorted((f"c{k}", f"mem:/i{k}.json") for k in range(n))


def test_one_document_for_each_address(spark, documents):
    docs = documents({"mem:/p.json": {"type": "FeatureCollection", "features": [], "links": [{"rel": "next", "href": "p.json"}]}})
    assert [(r["page_pos"], r["doc_uri"]) for r in sky.follow_pages(docs, "mem:/p.json").collect()] == [(0, "mem:/p.json")]
    with pytest.raises(ValueError, match="2 documents have the address 'mem:/p.json'"):
        sky.follow_pages(docs.unionByName(docs), "mem:/p.json")
    with pytest.raises(ValueError, match="2 documents have the address 'mem:/p.json'"):
        sky.crawl(docs.unionByName(docs), "mem:/p.json")


def test_read_catalog_opens_the_file_it_was_given(spark, tmp_path):
    folder = tmp_path / "my cat+1"
    (folder / "sub").mkdir(parents=True)
    write = lambda path, value: path.write_text(json.dumps(value))
    write(folder / "catalog.JSON", {"type": "Catalog", "id": "top", "links": [{"rel": "item", "href": "my item.json"}, {"rel": "item", "href": str(folder / "sub" / "b%20c.geojson")}]})
    write(folder / "my item.json", feature("one"))
    write(folder / "sub" / "b%20c.geojson", feature("two"))
    write(folder / "sub" / "catalog.json", {"type": "Catalog", "id": "sub", "links": []})
    got = sky.read_catalog(spark, str(folder / "catalog.JSON"))
    assert sorted((r["catalog"], r["id"]) for r in got.collect()) == [("top", "one"), ("top", "two")]
    with pytest.raises(FileNotFoundError):
        sky.read_catalog(spark, str(folder / "catalog.json"))


def test_only_linked_files_are_read(spark, tmp_path):
    """Links lead out of the root's folder and in circles; a file that nothing links to isn't opened; missing files are reported by the closure."""
    from skyledger.sources.linked import linked_documents

    def put(name, value):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(value if isinstance(value, str) else json.dumps(value))

    up = {"rel": "parent", "href": "../a/catalog.json"}
    put("a/catalog.json", {"type": "Catalog", "id": "a", "links": [{"rel": "child", "href": "../b/c.json"}, {"rel": "child", "href": "https://h/x.json"}, {"rel": "self", "href": "other.json"}]})
    put("a/other.json", "no JSON")
    put("b/c.json", {"type": "Collection", "id": "c", "links": [up, {"rel": "child", "href": "../a/catalog.json"}, {"rel": "item", "href": "x [1]/{i}.json"}, {"rel": "item", "href": "../d/j.json"}, {"rel": "items", "href": "p0.json"}]})
    put("b/x [1]/{i}.json", feature("i"))
    put("b/p0.json", {"type": "FeatureCollection", "features": [feature("k")], "links": [{"rel": "next", "href": "p1.json"}]})
    put("b/p1.json", {"type": "FeatureCollection", "features": [feature("l")], "links": []})
    root = f"file://{tmp_path}/a/catalog.json"
    for at_once in (1, 100):
        got = linked_documents(spark, root, at_once)
        assert sorted(r["doc_uri"].removeprefix(f"file://{tmp_path}/") for r in got.collect()) == ["a/catalog.json", "b/c.json", "b/p0.json", "b/p1.json", "b/x [1]/{i}.json"]
    with pytest.raises(FileNotFoundError, match="d/j.json"):
        sky.read_catalog(spark, root, on_missing="fail")
    put("d/j.json", feature("j"))
    put("a/catalog.json", {"type": "Catalog", "id": "a", "links": [{"rel": "child", "href": "../b/c.json"}]})
    items = sky.read_catalog(spark, root)
    assert sorted((r["catalog"], r["collection"], r["id"]) for r in items.collect()) == [("a", "c", i) for i in "ijkl"]


def test_local_files_are_opened_by_tasks(spark, tmp_path, monkeypatch):
    """A level of local files is one read, without Spark's list of them; empty, hidden and missing ones have no row; bytes come as they are."""
    from skyledger.sources import linked

    names = [f"i{n}.json" for n in range(300)]
    hrefs = [*names, "empty.json", "_hidden.json", ".dot.json", "gone.json", "folder.json", "bytes.json", f"file:{tmp_path}/one.json", f"file://{tmp_path}//two.json"]
    (tmp_path / "catalog.json").write_text(json.dumps({"type": "Catalog", "id": "c", "links": [{"rel": "item", "href": h} for h in hrefs]}))
    for name in [*names, "_hidden.json", ".dot.json", "one.json", "two.json"]:
        (tmp_path / name).write_text(json.dumps(feature(name)))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "folder.json").mkdir()
    (tmp_path / "bytes.json").write_bytes(b"\xff{")
    monkeypatch.setattr(linked, "HELD", 5_000)
    monkeypatch.setattr(linked, "_files", lambda *_: pytest.fail("a list of files was made"))
    got = {r["doc_uri"].removeprefix(f"file://{tmp_path}/"): r["b"] for r in linked.linked_documents(spark, f"file://{tmp_path}/catalog.json").select("doc_uri", F.col("body").cast("binary").alias("b")).collect()}
    assert got.keys() == {"catalog.json", *names, "bytes.json", "one.json", "two.json"} and got["bytes.json"] == b"\xff{"
    assert json.loads(got["i7.json"])["id"] == "i7.json"


def test_no_geometry_where_none_is_asked_for(spark, documents):
    docs = documents({"mem:/c.json": {"type": "Catalog", "id": "c", "links": [{"rel": "item", "href": "a.json"}]}, "mem:/a.json": feature("a")})
    schema = sky.infer_schema(sky.crawl(docs, "mem:/c.json"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan(sky.read(docs, "mem:/c.json", schema))
    few = sky.read(docs, "mem:/c.json", schema, columns=[], fixed=["id", "collection"])
    assert "regexp_replace" not in plan(few) and few.columns == ["collection", "id"] and few.count() == 1
    # without being told, too
    assert "regexp_replace" not in plan(sky.read(docs, "mem:/c.json", schema).select("id", "bbox"))
    with pytest.raises(ValueError, match="no fixed columns"):
        sky.read(docs, "mem:/c.json", schema, fixed=["datetime"])
