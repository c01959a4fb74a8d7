"""One query per operator, each with the SQL that must give the same rows straight from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import skyledger as sky
from skyledger.functions import geometry as geo
from skyledger.functions import json as js
from skyledger.functions.uri import is_static, resolve_href
from skyledger.operators.order import number_rows, offset_rows
from skyledger.operators.schema import sample_items
from skyledger.plans import document_sets as sets
from skyledger.plans.document_sets import landed, table
from skyledger.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TREE, STREAM, DEFECTS, REPEATS = "mem:/a/catalog.json", "mem:/b/collection.json", "mem:/d/catalog.json", "mem:/g/catalog.json"

ORDER_SCHEMA = T.StructType([
    T.StructField("datetime", T.StringType()), T.StructField("o:totalprice", T.DoubleType()), T.StructField("o:cust", T.LongType()),
    T.StructField("o:status", T.StringType()), T.StructField("o:priority", T.StringType()), T.StructField("o:big", T.BooleanType()),
    T.StructField("o:dims", T.StringType()), T.StructField("o:urgent", T.BooleanType()), T.StructField("o:note", T.StringType()),
])
EVENT_SCHEMA = T.StructType([
    T.StructField("datetime", T.StringType()), T.StructField("user:id", T.LongType()), T.StructField("eo:value", T.DoubleType()),
    T.StructField("raw", T.StringType()),
])

# Oracle side: the position rule and the tree of FIXTURES.md. {fan} is the most children a container lists.
_BOX = """
    CAST({k} % 359 AS DOUBLE) - CAST(179.5 AS DOUBLE) AS minx, CAST(({k} // 7) % 169 AS DOUBLE) - CAST(84.75 AS DOUBLE) AS miny,
    CAST({k} % 359 AS DOUBLE) - CAST(179.0 AS DOUBLE) AS maxx, CAST(({k} // 7) % 169 AS DOUBLE) - CAST(84.5 AS DOUBLE) AS maxy"""
_PLACED = f"""placed AS (
  SELECT o.*, n_nationkey, n_name, n_regionkey, r_name, 'o-' || o_orderkey AS id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'own-' || o_orderstatus ELSE n_name END AS collection,
    'mem:/a/r' || n_regionkey || '/n' || n_nationkey AS base,
    row_number() OVER (ORDER BY n_regionkey, n_nationkey, o_orderkey) - 1 AS place, {_BOX.format(k="o_orderkey")}
  FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_EVENTS = f"""ev AS (SELECT e.*, 'ev-' || event_id AS id, event_id // {sets.PAGE} AS p, {_BOX.format(k="event_id")} FROM events e)"""


# a string of set G that needs escapes in JSON
_PLAIN = "' \"' || c_mktsegment || '\" \\ ü' || chr(10) || (c_custkey % 7) || ' 漢'"


def query(name: str, oracle: str | None):
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = " ".join(oracle.split())
        return build

    return register


def _tree_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sky.crawl(landed(spark, sf_dir, "tree"), TREE)


def _tree_items(spark: SparkSession, sf_dir: str, columns=None, **options) -> DataFrame:
    return sky.read(landed(spark, sf_dir, "tree"), TREE, ORDER_SCHEMA, columns=columns, **options)


def _event_items(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return sky.read(landed(spark, sf_dir, "pages"), STREAM, EVENT_SCHEMA, **options)


def _corners(*more):
    return ["id", *[F.col(f"bbox.{c}").alias(c) for c in ("minx", "miny", "maxx", "maxy")], *more]


# -- sources -----------------------------------------------------------------------------------------------------------


@query("s1_scan_documents", f"""
    SELECT 'name=page-' || (event_id // {sets.PAGE}) AS folder, 'FeatureCollection' AS kind, count(*) AS n_features FROM events GROUP BY 1
    UNION ALL SELECT 'name=collection', 'Collection', NULL""")
def scan_documents(spark, sf_dir):
    pages = landed(spark, sf_dir, "pages")
    path = f"{Workspace(spark).root}/files"
    pages.select("body", F.regexp_extract("doc_uri", r"([^/]+)\.json$", 1).alias("name")).write.partitionBy("name").text(path)
    files = sky.with_kind(sky.read_documents(spark, path, "*.txt"))
    features = F.from_json("body", "features ARRAY<STRING>")["features"]
    return files.select(F.regexp_extract("doc_uri", r"(name=[^/]+)", 1).alias("folder"), "kind", F.when(features.isNotNull(), F.size(features)).cast("bigint").alias("n_features"))


@query("s1_read_catalog", f"""
    SELECT 'repeats' AS catalog, 'n' || c_nationkey AS collection, 'g-' || c_custkey AS id, {_PLAIN} AS segment FROM customer""")
def read_catalog(spark, sf_dir):
    """Set G as files: the root in a folder of its own, its collections in the one beside it, where a file that nothing links to isn't JSON."""
    root = f"{Workspace(spark).root}/catalogs"
    folder = root if "://" in root else f"file://{root}"
    documents = landed(spark, sf_dir, "repeats")
    top = F.col("doc_uri") == REPEATS
    moved = documents.select(
        F.when(top, "start/catalog.json").otherwise(F.substring("doc_uri", len("mem:/") + 1, 1000)).alias("name"),
        F.when(top, F.replace("body", F.lit('"href":"n'), F.lit('"href":"../g/n'))).otherwise(F.col("body")).alias("body"),
    ).unionByName(spark.createDataFrame([("g/unlinked.json", "no JSON")], "name string, body string"))

    def write(rows):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        made = set()
        for row in rows:
            path = f"{base}/{row['name']}"
            above = path.rpartition("/")[0]
            if above not in made:
                store.create_dir(above)
                made.add(above)
            with store.open_output_stream(path) as out:
                out.write(row["body"].encode())

    moved.foreachPartition(write)
    items = sky.read_catalog(spark, f"{folder}/start/catalog.json", schema=T.StructType([T.StructField("g:plain", T.StringType())]), fixed=["catalog", "collection", "id"])
    return items.select("catalog", "collection", "id", F.col("`g:plain`").alias("segment"))


def _responses(spark, sf_dir):
    path, _ = Workspace(spark).write(sets.responses(spark, sf_dir), "responses")
    return sky.read_responses(spark, path)


_URL = "'mem:/f/' || event_type || '/' || (user_id % 20)"


@query("s2_scan_responses", f"SELECT {_URL} AS doc_uri, event_id AS event FROM events WHERE event_id % 17 <> 0")
def scan_responses(spark, sf_dir):
    documents = sky.response_documents(_responses(spark, sf_dir), on_error="drop")
    return documents.select("doc_uri", F.from_json("body", "event BIGINT")["event"].alias("event"))


@query("s2_failed_responses", f"SELECT {_URL} AS url, 503 AS status, count(*) AS n FROM events WHERE event_id % 17 = 0 GROUP BY 1")
def failed_responses(spark, sf_dir):
    failed = sky.response_documents(_responses(spark, sf_dir), on_error="report")
    return failed.groupBy("url", "status").agg(F.count(F.lit(1)).alias("n"))


@query("s3_classify_source", r"""
    WITH u AS (SELECT url FROM pages UNION ALL
      SELECT 'https://h/' || o_orderkey || CASE o_orderkey % 4 WHEN 0 THEN '.json' WHEN 1 THEN '.GeoJSON' WHEN 2 THEN '.json?limit=10' ELSE '/items' END FROM orders)
    SELECT url, regexp_matches(lower(url), '\.(geo)?json$') AS is_static FROM u""")
def classify_source(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    ending = F.when(k == 0, ".json").when(k == 1, ".GeoJSON").when(k == 2, ".json?limit=10").otherwise("/items")
    made = table(spark, sf_dir, "orders").select(F.concat(F.lit("https://h/"), F.col("o_orderkey").cast("string"), ending).alias("url"))
    urls = table(spark, sf_dir, "pages").select("url").unionByName(made)
    return urls.select("url", is_static(F.col("url")).alias("is_static"))


@query("s4_freshest_response", f"""
    WITH RECURSIVE r AS (SELECT {_URL} AS url, ts, event_id FROM events WHERE event_id % 17 <> 0),
    kept AS (
      SELECT url, min(ts) AS ts FROM r GROUP BY url
      UNION ALL
      SELECT k.url, min(r.ts) AS ts FROM kept k JOIN r ON r.url = k.url AND r.ts > k.ts + INTERVAL {sets.RESPONSE_TTL} SECOND GROUP BY k.url)
    SELECT r.url, r.event_id AS event FROM r JOIN kept ON r.url = kept.url AND r.ts = kept.ts""")
def freshest_response(spark, sf_dir):
    fresh = sky.freshest_response(landed(spark, sf_dir, "responses"), sets.RESPONSE_TTL)
    return fresh.select("url", F.from_json("body", "event BIGINT")["event"].alias("event"))


@query("s4_hot_request", f"""
    WITH RECURSIVE r AS (SELECT ts, event_id FROM events WHERE event_id % 17 <> 0),
    kept AS (SELECT min(ts) AS ts FROM r UNION ALL SELECT min(r.ts) FROM kept k, r WHERE r.ts > k.ts + INTERVAL {sets.RESPONSE_TTL} SECOND HAVING min(r.ts) IS NOT NULL)
    SELECT event_id AS event FROM r JOIN kept ON r.ts = kept.ts""")
def hot_request(spark, sf_dir):
    """All responses belong to one request."""
    one = landed(spark, sf_dir, "responses").withColumn("url", F.lit("mem:/f/one"))
    return sky.freshest_response(one, sets.RESPONSE_TTL).select(F.from_json("body", "event BIGINT")["event"].alias("event"))


@query("s5_validate_documents", """
    SELECT 'mem:/d/items/' || c_custkey || '.json' AS doc_uri,
      CASE c_custkey % 12 WHEN 9 THEN 'missing ''type'' field' ELSE 'unparsable document' END AS problem
    FROM customer WHERE c_custkey % 12 IN (9, 10)""")
def validate_documents(spark, sf_dir):
    return sky.validate(landed(spark, sf_dir, "defects"), on_error="report")


_INDEX = f"(o_orderkey // {sets.FAN})"


@query("s6_dispatch_kind", f"""
    WITH {_PLACED}, {_EVENTS}, d AS (
      SELECT '{TREE}' AS doc_uri, 'Catalog' AS kind UNION ALL SELECT 'mem:/a/r' || r_regionkey || '/catalog.json', 'Catalog' FROM region
      UNION ALL SELECT DISTINCT base || '/collection.json', 'Collection' FROM placed
      UNION ALL SELECT DISTINCT base || '/idx/l1-' || {_INDEX} || '.json', 'Collection' FROM placed
      UNION ALL SELECT base || '/items/' || o_orderkey || '.json', 'Feature' FROM placed
      UNION ALL SELECT '{STREAM}', 'Collection' UNION ALL SELECT DISTINCT 'mem:/b/page-' || p || '.json', 'FeatureCollection' FROM ev)
    SELECT * FROM d""")
def dispatch_kind(spark, sf_dir):
    documents = landed(spark, sf_dir, "tree").unionByName(landed(spark, sf_dir, "pages"))
    return sky.with_kind(documents).select("doc_uri", "kind")


# -- link graph --------------------------------------------------------------------------------------------------------


@query("t1_explode_links", f"""
    WITH {_EVENTS}, pg AS (SELECT DISTINCT p FROM ev)
    SELECT '{STREAM}' AS doc_uri, 0 AS pos, 'items' AS rel, './page-0.json' AS href, 'GET' AS method, false AS merge, NULL AS page, NULL AS token
    UNION ALL SELECT 'mem:/b/page-' || p || '.json', 0, 'self', './page-' || p || '.json', 'GET', false, NULL, NULL FROM pg
    UNION ALL SELECT 'mem:/b/page-' || p || '.json', 1, 'next', './page-' || (p + 1) || '.json', CASE WHEN p % 2 = 0 THEN 'GET' ELSE 'POST' END,
      p % 2 = 1, CAST(p + 1 AS VARCHAR), CAST(p + 1 AS VARCHAR) FROM pg WHERE p < (SELECT max(p) FROM pg)
    UNION ALL SELECT 'mem:/d/items/' || c_custkey || '.json', 0, 'self', 'x', 'GET', false, NULL, NULL FROM customer WHERE c_custkey % 12 <> 10
    UNION ALL SELECT 'mem:/d/items/' || c_custkey || '.json', 1, 'z', 'y', 'GET', false, NULL, NULL FROM customer WHERE c_custkey % 12 NOT IN (8, 10)
    UNION ALL SELECT DISTINCT '{DEFECTS}', c_custkey // {sets.FAN}, 'child', './idx/l1-' || (c_custkey // {sets.FAN}) || '.json', 'GET', false, NULL, NULL FROM customer
    UNION ALL SELECT 'mem:/d/idx/l1-' || (c_custkey // {sets.FAN}) || '.json', c_custkey % {sets.FAN}, 'item', '../items/' || c_custkey || '.json', 'GET', false, NULL, NULL FROM customer""")
def explode_links(spark, sf_dir):
    documents = landed(spark, sf_dir, "pages").unionByName(landed(spark, sf_dir, "defects"))
    return sky.explode_links(documents).select(
        "doc_uri", "pos", "rel", "href", "method", "merge", F.col("headers")["x-page"].alias("page"),
        F.get_json_object("body", "$.token").alias("token"),
    )


@query("t2_resolve_href", f"""
    WITH {_PLACED}, ix AS (SELECT DISTINCT base, {_INDEX} AS g FROM placed)
    SELECT '{TREE}' AS doc_uri, 'child' AS rel, 'mem:/a/r' || r_regionkey || '/catalog.json' AS target FROM region
    UNION ALL SELECT 'mem:/a/r' || r_regionkey || '/catalog.json', 'parent', '{TREE}' FROM region
    UNION ALL SELECT 'mem:/a/r' || n_regionkey || '/catalog.json', 'child', 'mem:/a/r' || n_regionkey || '/n' || n_nationkey || '/collection.json' FROM nation
    UNION ALL SELECT DISTINCT base || '/collection.json', 'parent', 'mem:/a/r' || n_regionkey || '/catalog.json' FROM placed
    UNION ALL SELECT base || '/collection.json', 'child', base || '/idx/l1-' || g || '.json' FROM ix
    UNION ALL SELECT base || '/idx/l1-' || {_INDEX} || '.json', 'item', base || '/items/' || o_orderkey || '.json' FROM placed
    UNION ALL SELECT '{TREE}', rel, '{TREE}' FROM (VALUES ('root'), ('self')) v(rel)
    UNION ALL SELECT base || '/items/' || o_orderkey || '.json', rel, CASE rel WHEN 'root' THEN '/a/catalog.json' ELSE base || '/items/' || o_orderkey || '.json' END
      FROM placed, (VALUES ('root'), ('self')) v(rel)""")
def resolve_hrefs(spark, sf_dir):
    links = sky.explode_links(landed(spark, sf_dir, "tree"))
    return links.select("doc_uri", "rel", resolve_href(F.col("doc_uri"), F.col("href")).alias("target"))


@query("t3_crawl", f"""
    WITH {_PLACED} SELECT r_name AS catalog, n_name AS collection, base || '/items/' || o_orderkey || '.json' AS doc_uri FROM placed""")
def crawl(spark, sf_dir):
    return _tree_raw(spark, sf_dir).select("catalog", "collection", "doc_uri")


@query("t3_repeated_keys", """
    SELECT 'repeats' AS catalog, 'n' || c_nationkey AS collection, 'mem:/g/items/' || c_custkey || '.json' AS doc_uri FROM customer""")
def repeated_link_keys(spark, sf_dir):
    return sky.crawl(landed(spark, sf_dir, "repeats"), REPEATS).select("catalog", "collection", "doc_uri")


@query("t8_mesh", """
    SELECT n_name AS catalog, 'mem:/h/items/' || s_suppkey || '.json' AS doc_uri FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def mesh(spark, sf_dir):
    return sky.crawl(landed(spark, sf_dir, "mesh"), "mem:/h/c0.json").select("catalog", "doc_uri")


@query("t4_circles", """
    WITH n AS (SELECT count(*) AS n FROM nation), h AS (SELECT * FROM (VALUES (0), (7)) v(head))
    SELECT 'mem:/h/page-' || head || '.json' AS first_uri, 'mem:/h/page-' || n_nationkey || '.json' AS doc_uri, CAST((n_nationkey - head + n) % n AS BIGINT) AS page_pos FROM nation, h, n""")
def page_circles(spark, sf_dir):
    pages = sky.follow_pages(landed(spark, sf_dir, "mesh"), ["mem:/h/page-0.json", "mem:/h/page-7.json"])
    return pages.select("first_uri", "doc_uri", "page_pos")


@query("t3_missing_targets", f"""
    WITH {_PLACED} SELECT base || '/items/' || o_orderkey || '.json' AS doc_uri, base || '/idx/l1-' || {_INDEX} || '.json' AS parent_uri
    FROM placed WHERE o_orderstatus = 'P'""")
def missing_targets(spark, sf_dir):
    kept = landed(spark, sf_dir, "tree").where("NOT contains(body, '\"o:status\":\"P\"')")
    return sky.missing_targets(kept, TREE)


@query("t4_follow_pages", f"""
    WITH {_EVENTS} SELECT p AS page_pos, 'mem:/b/page-' || p || '.json' AS doc_uri, count(*) AS n_features FROM ev GROUP BY p""")
def follow_pages(spark, sf_dir):
    chain = sky.follow_pages(landed(spark, sf_dir, "pages"), "mem:/b/page-0.json")
    features = F.size(F.from_json("body", "features ARRAY<STRING>")["features"]).cast("bigint")
    return chain.select("page_pos", "doc_uri", features.alias("n_features"))


def _feature_id(c="feature"):
    return F.from_json(c, "id STRING")["id"].alias("id")


@query("t5_crawl_order", f"WITH {_PLACED} SELECT id, place FROM placed")
def crawl_order(spark, sf_dir):
    items = _tree_raw(spark, sf_dir).select("page_pos", "dfs_path", _feature_id())
    return number_rows(items, ("page_pos", "dfs_path"), "place").select("id", "place")


@query("t5_page_order", "SELECT 'ev-' || event_id AS id, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events")
def page_order(spark, sf_dir):
    items = sky.crawl(landed(spark, sf_dir, "pages"), STREAM).select("page_pos", "dfs_path", _feature_id())
    return number_rows(items, ("page_pos", "dfs_path"), "place").select("id", "place")


@query("t6_inherit_ids", f"WITH {_PLACED} SELECT id, r_name AS catalog, collection FROM placed")
def inherit_ids(spark, sf_dir):
    return sky.inherit_ids(_tree_raw(spark, sf_dir)).select(_feature_id(), "catalog", "collection")


@query("t7_explode_features", f"""
    WITH {_EVENTS} SELECT 'mem:/b/page-' || p || '.json' AS doc_uri, row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS feature_pos, id FROM ev""")
def explode_features(spark, sf_dir):
    return sky.explode_features(landed(spark, sf_dir, "pages")).select("doc_uri", "feature_pos", _feature_id())


@query("t8_cycle_guard", f"""
    WITH {_PLACED} SELECT DISTINCT base || '/idx/l1-' || {_INDEX} || '.json' AS doc_uri, '{TREE}' AS target_uri FROM placed""")
def cycle_guard(spark, sf_dir):
    return sky.cycles(sets.tree(spark, sf_dir, back_links=True), TREE).select("doc_uri", "target_uri")


# -- schema inference --------------------------------------------------------------------------------------------------

# name, class, text position, and whether only urgent orders have it
_PROPERTIES = """props AS (SELECT * FROM (VALUES ('datetime','string',0,false),('o:totalprice','double',1,false),('o:cust','bigint',2,false),
    ('o:status','string',3,false),('o:priority','string',4,false),('o:big','boolean',5,false),('o:dims','json',6,false),
    ('o:urgent','boolean',7,true),('o:note','null',8,false)) t(name, type, pos, urgent))"""
_FIRST_SEEN = """seen AS (SELECT props.name, props.type, min(place * 100 + pos) AS first FROM props JOIN placed
    ON NOT props.urgent OR o_orderpriority = '1-URGENT' GROUP BY 1, 2)"""


@query("i1_property_names", f"WITH {_PLACED}, {_PROPERTIES}, {_FIRST_SEEN} SELECT name, row_number() OVER (ORDER BY first) - 1 AS ordinal FROM seen")
def property_names(spark, sf_dir):
    return sky.property_names(_tree_raw(spark, sf_dir)).select("name", F.col("ordinal").cast("bigint").alias("ordinal"))


@query("i2_property_types", f"""
    WITH {_PLACED}, {_PROPERTIES} SELECT name, type, count(*) AS n FROM props JOIN placed
    ON NOT props.urgent OR o_orderpriority = '1-URGENT' GROUP BY 1, 2""")
def property_types(spark, sf_dir):
    return sky.property_types(_tree_raw(spark, sf_dir))


@query("i2_repeated_keys", """
    SELECT name, type, count(*) AS n FROM customer, (VALUES ('g:twice', 'bigint'), ('g:nested', 'json'), ('g:plain', 'string')) v(name, type) GROUP BY name, type""")
def repeated_property_keys(spark, sf_dir):
    return sky.property_types(sky.crawl(landed(spark, sf_dir, "repeats"), REPEATS))


@query("p6_repeated_keys", f"""
    SELECT 'g-' || c_custkey AS id, c_custkey AS twice, CAST(c_custkey AS VARCHAR) AS nested, {_PLAIN} AS plain, 'a-' || c_custkey AS a, 'b' AS b, 2 AS n FROM customer""")
def repeated_asset_keys(spark, sf_dir):
    items = sky.read(landed(spark, sf_dir, "repeats"), REPEATS)
    return items.select(
        "id", F.col("`g:twice`").alias("twice"), F.from_json("`g:nested`", "k STRING")["k"].alias("nested"), F.col("`g:plain`").alias("plain"),
        F.col("assets")["a"]["href"].alias("a"), F.col("assets")["b"]["href"].alias("b"), F.size("assets").alias("n"),
    )


@query("i3_first_item_sample", f"""
    WITH {_PLACED}, f AS (SELECT *, row_number() OVER (PARTITION BY base, {_INDEX} ORDER BY o_orderkey) AS nth FROM placed),
    t AS (SELECT *, row_number() OVER (PARTITION BY r_name, collection ORDER BY place) AS of_type FROM f WHERE nth = 1)
    SELECT id, r_name AS catalog, collection FROM t WHERE of_type = 1""")
def first_item_sample(spark, sf_dir):
    return sample_items(_tree_raw(spark, sf_dir)).select(_feature_id(), "catalog", "collection")


@query("i4_merge_schema", f"""
    WITH {_PLACED}, {_PROPERTIES}, {_FIRST_SEEN}
    SELECT 'tree' AS source, name, CASE type WHEN 'null' THEN 'json' ELSE type END AS type, row_number() OVER (ORDER BY first) - 1 AS ordinal FROM seen
    UNION ALL SELECT 'defects', name, CASE WHEN count(DISTINCT t) = 1 THEN min(t) WHEN name = 'd:mixed' THEN 'double' ELSE 'json' END, row_number() OVER (ORDER BY min(place)) - 1 FROM (
      SELECT 'd:mixed' AS name, CASE WHEN c_custkey % 2 = 0 THEN 'bigint' ELSE 'double' END AS t, c_custkey * 3 AS place FROM customer WHERE c_custkey % 12 NOT IN (9, 10)
      UNION ALL SELECT 'd:any', CASE WHEN c_custkey % 3 = 0 THEN 'bigint' ELSE 'string' END, c_custkey * 3 + 1 FROM customer WHERE c_custkey % 12 NOT IN (9, 10)
      UNION ALL SELECT 'd:late', 'boolean', c_custkey * 3 + 2 FROM customer WHERE c_custkey % 12 = 11) d GROUP BY name""")
def merge_schema(spark, sf_dir):
    broken = sky.crawl(landed(spark, sf_dir, "defects"), DEFECTS, on_error="drop")
    both = [(s, sky.merge_schema(raw)) for s, raw in (("tree", _tree_raw(spark, sf_dir)), ("defects", broken))]
    rows = [df.select(F.lit(s).alias("source"), "name", "type", F.col("ordinal").cast("bigint").alias("ordinal")) for s, df in both]
    return rows[0].unionByName(rows[1])


@query("i4_merge_first_item", """
    WITH f AS (SELECT min(c_custkey) AS k FROM customer)
    SELECT 'd:mixed' AS name, CASE WHEN k % 2 = 0 THEN 'bigint' ELSE 'double' END AS type, 0 AS ordinal FROM f
    UNION ALL SELECT 'd:any', CASE WHEN k % 3 = 0 THEN 'bigint' ELSE 'string' END, 1 FROM f""")
def merge_first_item(spark, sf_dir):
    broken = sky.crawl(landed(spark, sf_dir, "defects"), DEFECTS, on_error="drop")
    return sky.merge_schema(broken, "first_item").select("name", "type", F.col("ordinal").cast("bigint").alias("ordinal"))


@query("i4_infer_and_read", f"""
    WITH {_PLACED} SELECT id, o_totalprice AS price, CAST(o_custkey AS BIGINT) AS cust, o_totalprice > 200000 AS big,
      CASE WHEN o_orderpriority = '1-URGENT' THEN true END AS urgent, '[' || (o_orderkey % 7) || ',' || (o_orderkey % 11) || ']' AS dims FROM placed""")
def infer_and_read(spark, sf_dir):
    items = sky.read(landed(spark, sf_dir, "tree"), TREE)
    return items.select(
        "id", F.col("`o:totalprice`").alias("price"), F.col("`o:cust`").alias("cust"), F.col("`o:big`").alias("big"),
        F.col("`o:urgent`").alias("urgent"), F.col("`o:dims`").alias("dims"),
    )


@query("i5_align_to_schema", f"WITH {_PLACED} SELECT id, o_totalprice AS price, CAST(NULL AS DOUBLE) AS absent, 10 AS n_columns FROM placed")
def align_to_schema(spark, sf_dir):
    schema = T.StructType([T.StructField("o:totalprice", T.DoubleType()), T.StructField("o:absent", T.DoubleType())])
    items = sky.items(_tree_raw(spark, sf_dir), schema)
    return items.select("id", F.col("`o:totalprice`").alias("price"), F.col("`o:absent`").alias("absent"), F.lit(len(items.columns)).alias("n_columns"))


# -- projections -------------------------------------------------------------------------------------------------------

_WKT = "'POLYGON ((' || list_aggregate([minx || ' ' || miny, maxx || ' ' || miny, maxx || ' ' || maxy, minx || ' ' || maxy, minx || ' ' || miny], 'string_agg', ', ') || '))'"


@query("p1_project_items", f"""
    WITH {_PLACED} SELECT r_name AS catalog, collection, id, minx, miny, maxx, maxy,
      ST_AsText(ST_GeomFromGeoJSON('{{"type":"Polygon","coordinates":[[[' || minx || ',' || miny || '],[' || maxx || ',' || miny || '],[' || maxx || ',' || maxy || '],[' || minx || ',' || maxy || '],[' || minx || ',' || miny || ']]]}}')) AS geometry,
      'ext:' || (o_orderkey % 3) || ',proj' AS extensions, 'root self' AS rels, 'data,thumb' AS asset_names,
      strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS datetime, o_totalprice AS price, o_orderpriority AS priority FROM placed""")
def project_items(spark, sf_dir):
    return _tree_items(spark, sf_dir).select(
        "catalog", "collection", *_corners(), "geometry", F.array_join("stac_extensions", ",").alias("extensions"),
        F.array_join(F.col("links")["rel"], " ").alias("rels"), F.array_join(F.map_keys("assets"), ",").alias("asset_names"),
        "datetime", F.col("`o:totalprice`").alias("price"), F.col("`o:priority`").alias("priority"),
    )


@query("p2_require_fields", """
    SELECT 'mem:/d/items/' || c_custkey || '.json' AS doc_uri, CASE c_custkey % 12 WHEN 1 THEN 'id' WHEN 2 THEN 'geometry' WHEN 3 THEN 'bbox' ELSE 'stac_extensions' END AS missing
    FROM customer WHERE c_custkey % 12 IN (1, 2, 3, 6)""")
def require_fields(spark, sf_dir):
    broken = sky.crawl(landed(spark, sf_dir, "defects"), DEFECTS, on_error="drop")
    return sky.require_fields(broken, strict=False).select("doc_uri", F.array_join("missing", ",").alias("missing"))


def _defect_member(spark, sf_dir, member, json_type="STRING"):
    features = sky.explode_features(landed(spark, sf_dir, "defects"))
    return features.select("doc_uri", F.from_json("feature", f"{member} {json_type}")[member].alias("json"))


_GOOD = "FROM customer WHERE c_custkey % 12 NOT IN (9, 10)"
_DOC = "'mem:/d/items/' || c_custkey || '.json' AS doc_uri"


@query("p3_bbox_struct", f"""
    WITH d AS (SELECT c_custkey, {_DOC}, {_BOX.format(k="c_custkey")}, CAST((c_custkey // 12) % 100 AS DOUBLE) AS w {_GOOD})
    SELECT doc_uri, CASE c_custkey % 12 WHEN 3 THEN NULL WHEN 4 THEN w ELSE minx END AS minx, CASE c_custkey % 12 WHEN 3 THEN NULL WHEN 4 THEN w + 1 ELSE miny END AS miny,
      CASE c_custkey % 12 WHEN 3 THEN NULL WHEN 4 THEN w + 2 ELSE maxx END AS maxx, CASE c_custkey % 12 WHEN 3 THEN NULL WHEN 4 THEN w + 3 ELSE maxy END AS maxy FROM d""")
def bbox_struct(spark, sf_dir):
    boxes = _defect_member(spark, sf_dir, "bbox").select("doc_uri", js.bbox_struct(F.col("json")).alias("b"))
    return boxes.select("doc_uri", "b.*")


@query("p4_string_list", f"SELECT {_DOC}, CASE WHEN c_custkey % 12 <> 6 THEN 'e' END AS extensions {_GOOD}")
def string_list(spark, sf_dir):
    lists = _defect_member(spark, sf_dir, "stac_extensions")
    return lists.select("doc_uri", F.array_join(js.string_list(F.col("json")), ",").alias("extensions"))


@query("p5_link_structs", f"SELECT {_DOC}, CASE WHEN c_custkey % 12 = 8 THEN 'self|x||' ELSE 'self|x||;z|y||' END AS links {_GOOD}")
def link_structs(spark, sf_dir):
    links = _defect_member(spark, sf_dir, "links").select("doc_uri", js.link_structs(F.col("json")).alias("links"))
    one = F.transform("links", lambda l: F.concat_ws("|", l["rel"], l["href"], l["type"], l["title"]))
    return links.select("doc_uri", F.array_join(one, ";").alias("links"))


@query("p6_asset_map", f"SELECT {_DOC}, 'c' AS names, 'c' AS href, '' AS title, 0 AS n_roles {_GOOD}")
def asset_map(spark, sf_dir):
    assets = _defect_member(spark, sf_dir, "assets").select("doc_uri", js.asset_map(F.col("json")).alias("a"))
    return assets.select(
        "doc_uri", F.array_join(F.map_keys("a"), ",").alias("names"), F.col("a")["c"]["href"].alias("href"),
        F.col("a")["c"]["title"].alias("title"), F.size(F.col("a")["c"]["roles"]).alias("n_roles"),
    )


@query("p6_item_assets", f"""
    WITH {_PLACED} SELECT id, 's3://o/' || o_orderkey || '.tif' AS href, 'image/tiff' AS type, 'data' AS roles, 'small' AS description, '' AS no_title FROM placed""")
def item_assets(spark, sf_dir):
    data, thumb = F.col("assets")["data"], F.col("assets")["thumb"]
    return _tree_items(spark, sf_dir, columns=[]).select(
        "id", data["href"].alias("href"), data["type"].alias("type"), F.array_join(data["roles"], ",").alias("roles"),
        thumb["description"].alias("description"), data["title"].alias("no_title"),
    )


@query("p7_promote_properties", f"""
    WITH {_PLACED} SELECT id, o_totalprice AS "o:totalprice", CAST(o_custkey AS BIGINT) AS "o:cust", o_orderstatus AS "o:status", o_totalprice > 200000 AS "o:big",
      CASE WHEN o_orderpriority = '1-URGENT' THEN true END AS "o:urgent", CAST(NULL AS VARCHAR) AS "o:note" FROM placed""")
def promote_properties(spark, sf_dir):
    return _tree_items(spark, sf_dir).select("id", *[F.col(f"`o:{c}`") for c in ("totalprice", "cust", "status", "big", "urgent", "note")])


@query("p8_json_passthrough", "SELECT 'ev-' || event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, replace(props, ' ', '') AS raw FROM events")
def json_passthrough(spark, sf_dir):
    features = sky.explode_features(landed(spark, sf_dir, "pages"))
    raw = js.json_text(F.col("feature"), "$.properties.raw")
    return features.select(_feature_id(), F.get_json_object(raw, "$.k").cast("bigint").alias("k"), raw.alias("raw"))


@query("p9_column_pruning", f"WITH {_PLACED} SELECT id, o_orderstatus AS status FROM placed")
def column_pruning(spark, sf_dir):
    return _tree_items(spark, sf_dir, columns=["o:status"], fixed=["id"]).select("id", F.col("`o:status`").alias("status"))


@query("p10_struct_cast", f"WITH {_EVENTS} SELECT id, minx, miny, maxx, maxy FROM ev")
def struct_cast(spark, sf_dir):
    plain = _event_items(spark, sf_dir).withColumn("bbox", F.col("bbox").cast("struct<minx:double,miny:double,maxx:double,maxy:double>"))
    return plain.select("id", "bbox.*")


# -- geometry ----------------------------------------------------------------------------------------------------------

_AT = "'[' || (x + {0}) || ',' || (y + {1}) || ']'"


def _ring(*points):
    return "'[' || " + " || ',' || ".join(_AT.format(*[f"CAST({v} AS DOUBLE)" for v in p]) for p in points) + " || ']'"


_SQUARE, _HOLE = _ring((0, 0), (2, 0), (2, 2), (0, 2), (0, 0)), _ring((0.5, 0.5), (0.75, 0.5), (0.75, 0.75), (0.5, 0.5))
_PT, _LN = _AT.format("CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)"), _ring((0, 0), (1, 0.5), (2, 0.25))
_FAR = _ring((4, 4), (5, 4), (5, 5), (4, 4))
_PARTS = f"""pt AS (SELECT p_partkey, CAST(p_partkey % 359 AS DOUBLE) - CAST(179.5 AS DOUBLE) AS x, CAST((p_partkey // 7) % 169 AS DOUBLE) - CAST(84.75 AS DOUBLE) AS y FROM part),
    gj AS (SELECT p_partkey, x, y, CASE p_partkey % 7
      WHEN 0 THEN '{{"type":"Point","coordinates":' || {_PT} || '}}'
      WHEN 1 THEN '{{"type":"LineString","coordinates":' || {_LN} || '}}'
      WHEN 2 THEN '{{"type":"Polygon","coordinates":[' || {_SQUARE} || CASE WHEN p_partkey % 14 = 2 THEN ',' || {_HOLE} ELSE '' END || ']}}'
      WHEN 3 THEN '{{"type":"MultiPoint","coordinates":' || {_ring((0, 0), (1, 1))} || '}}'
      WHEN 4 THEN '{{"type":"MultiLineString","coordinates":[' || {_ring((0, 0), (1, 0))} || ',' || {_ring((0, 1), (1, 1))} || ']}}'
      WHEN 5 THEN '{{"type":"MultiPolygon","coordinates":[[' || {_SQUARE} || '],[' || {_FAR} || ']]}}'
      ELSE '{{"type":"GeometryCollection","geometries":[{{"type":"Point","coordinates":' || {_PT} || '}},{{"type":"LineString","coordinates":' || {_LN} || '}}]}}' END AS g FROM pt)"""


@query("g1_geojson_to_wkt", f"WITH {_PARTS} SELECT p_partkey, ST_AsText(ST_GeomFromGeoJSON(g)) AS wkt FROM gj")
def geojson_to_wkt(spark, sf_dir):
    wkt = sky.geojson_to_wkt(landed(spark, sf_dir, "geometries"), "geometry")
    # the other engine prints the points of a MULTIPOINT without parentheses of their own
    bare = F.when(F.col("geometry").startswith("MULTIPOINT"), F.regexp_replace("geometry", r"\(([^()]+)\)", "$1")).otherwise(F.col("geometry"))
    return wkt.select("p_partkey", bare.alias("wkt"))


@query("g2_wkt_to_geojson", f"""
    WITH {_PARTS}, j AS (SELECT p_partkey, CAST(ST_AsGeoJSON(ST_GeomFromGeoJSON(g)) AS VARCHAR) AS g FROM gj)
    SELECT p_partkey, json_extract_string(g, '$.type') AS kind,
      array_to_string(list_transform(regexp_extract_all(g, '-?[0-9]+\\.[0-9]+'), lambda n: CAST(CAST(n AS DECIMAL(18,4)) AS VARCHAR)), ' ') AS numbers,
      regexp_replace(regexp_replace(g, '-?[0-9]+\\.[0-9]+', '#', 'g'), '[^#\\[\\]]', '', 'g') AS nesting FROM j""")
def wkt_to_geojson(spark, sf_dir):
    wkt = sky.geojson_to_wkt(landed(spark, sf_dir, "geometries"), "geometry")
    back = sky.wkt_to_geojson(wkt, "geometry")
    numbers = F.transform(F.regexp_extract_all("geometry", F.lit(r"(-?\d+\.\d+)"), F.lit(1)), lambda n: n.cast("decimal(18,4)").cast("string"))
    # brackets with # for each number
    nesting = F.regexp_replace(F.regexp_replace("geometry", r"-?\d+\.\d+", "#"), r"[^#\[\]]", "")
    return back.select("p_partkey", F.get_json_object("geometry", "$.type").alias("kind"), F.array_join(numbers, " ").alias("numbers"), nesting.alias("nesting"))


@query("g3_make_envelope", f"""
    WITH {_PLACED} SELECT id, minx, miny, maxx, maxy FROM placed""")
def make_envelope(spark, sf_dir):
    k = F.col("o_orderkey")
    x0, y0, x1, y1 = sets.corners(k)
    swapped = (k % 2 == 0, k % 3 == 0)
    box = sky.make_envelope(
        F.when(swapped[0], x1).otherwise(x0), F.when(swapped[1], y1).otherwise(y0),
        F.when(swapped[0], x0).otherwise(x1), F.when(swapped[1], y0).otherwise(y1),
    )
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("o-"), k.cast("string")).alias("id"), box.alias("b")).select("id", "b.*")


@query("g4_bbox_overlap", f"WITH {_PLACED} SELECT id FROM placed WHERE (minx <= 20 OR maxx >= 170) AND miny <= 30.25 AND maxy >= -10")
def bbox_overlap(spark, sf_dir):
    crossing = F.struct(F.lit(170.0).alias("minx"), F.lit(-10.0).alias("miny"), F.lit(20.0).alias("maxx"), F.lit(30.25).alias("maxy"))
    return _tree_items(spark, sf_dir, columns=[]).where(geo.bbox_overlaps(F.col("bbox"), crossing)).select("id")


@query("g5_geom_intersects", f"""
    WITH {_PLACED} SELECT id FROM placed WHERE maxx >= 10 AND maxy >= -20 AND minx <= 40 AND miny <= 15
      AND NOT (minx > 15 AND miny > -15 AND maxx < 35 AND maxy < 10)""")
def geom_intersects(spark, sf_dir):
    frame = "POLYGON ((10 -20, 40 -20, 40 15, 10 15, 10 -20), (15 -15, 35 -15, 35 10, 15 10, 15 -15))"
    shape, _ = geo.shape_literal(spark, F.lit(frame))
    items = _tree_items(spark, sf_dir, columns=[])
    return items.where(geo.geom_intersects(geo.shape_of_wkt(F.col("geometry")), shape)).select("id")


# -- search ------------------------------------------------------------------------------------------------------------


@query("q1_search_collections", f"WITH {_EVENTS} SELECT id, event_type AS collection FROM ev WHERE event_type IN ('click', 'view')")
def search_collections(spark, sf_dir):
    return sky.search(_event_items(spark, sf_dir), collections=["click", "view"]).select("id", "collection")


@query("q2_search_ids", f"WITH {_EVENTS} SELECT id, user_id FROM ev WHERE id IN ('ev-3', 'ev-77', 'ev-78', 'ev-4711')")
def search_ids(spark, sf_dir):
    found = sky.search(_event_items(spark, sf_dir), ids=["ev-3", "ev-77", "ev-78", "ev-4711", "ev-none"])
    return found.select("id", F.col("`user:id`").alias("user_id"))


# more ids than a plan should spell out
@query("q2_search_many_ids", f"WITH {_EVENTS} SELECT id, user_id FROM ev WHERE event_id % 3 = 0")
def search_many_ids(spark, sf_dir):
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    wanted = [f"ev-{k}" for k in range(0, last + 1, 3)] + [f"none-{k}" for k in range(2000)]
    return sky.search(_event_items(spark, sf_dir), ids=wanted).select("id", F.col("`user:id`").alias("user_id"))


@query("q3_search_datetime", f"WITH {_EVENTS} SELECT id FROM ev WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'")
def search_datetime(spark, sf_dir):
    return sky.search(_event_items(spark, sf_dir), datetime="2024-01-05/2024-01-11").select("id")


@query("q3_search_open_end", f"WITH {_EVENTS} SELECT id FROM ev WHERE ts >= TIMESTAMP '2024-01-20 10:30:00'")
def search_open_end(spark, sf_dir):
    return sky.search(_event_items(spark, sf_dir), datetime="2024-01-20T12:30:00+02:00/..").select("id")


@query("q4_search_bbox", f"WITH {_EVENTS} SELECT id FROM ev WHERE minx <= 30.25 AND maxx >= -20 AND miny <= 40 AND maxy >= 10.5")
def search_bbox(spark, sf_dir):
    return sky.search(_event_items(spark, sf_dir), bbox=[-20.0, 10.5, 30.25, 40.0]).select("id")


@query("q4_search_bbox_crossing", f"WITH {_EVENTS} SELECT id FROM ev WHERE (maxx >= 160 OR minx <= -150) AND miny <= 40 AND maxy >= -40")
def search_bbox_crossing(spark, sf_dir):
    return sky.search(_event_items(spark, sf_dir), bbox=[160.0, -40.0, -150.0, 40.0]).select("id")


@query("q5_search_intersects", f"WITH {_EVENTS} SELECT id FROM ev WHERE minx <= 30.25 AND maxx >= -20 AND miny <= 40 AND maxy >= 10.5")
def search_intersects(spark, sf_dir):
    rectangle = "POLYGON ((-20 10.5, 30.25 10.5, 30.25 40, -20 40, -20 10.5))"
    return sky.search(_event_items(spark, sf_dir), intersects=rectangle).select("id")


# y <= a * x + b along the slanted edges; a rectangle meets the triangle when no edge of either keeps them apart
@query("q5_search_triangle", f"""
    WITH {_EVENTS} SELECT id FROM ev WHERE minx <= 60 AND maxx >= 0 AND miny <= 60 AND maxy >= 0 AND minx + miny <= 60""")
def search_triangle(spark, sf_dir):
    return sky.search(_event_items(spark, sf_dir), intersects="POLYGON ((0 0, 60 0, 0 60, 0 0))").select("id")


@query("q6_search_page_size", f"""
    WITH {_EVENTS} SELECT id, (row_number() OVER (ORDER BY id) - 1) // 250 AS page_no FROM ev WHERE event_type = 'view'""")
def search_page_size(spark, sf_dir):
    return sky.search(_event_items(spark, sf_dir), collections=["view"], max_items=250).select("id", "page_no")


@query("q7_search_all", f"""
    WITH {_EVENTS} SELECT id, event_type AS collection FROM ev WHERE event_type IN ('click', 'error') AND ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-25 00:00:00'
      AND minx <= 90 AND maxx >= -90 AND miny <= 45 AND maxy >= -45 AND minx <= 60 AND maxx >= -120 AND miny <= 40 AND maxy >= -60""")
def search_all(spark, sf_dir):
    found = sky.search(
        _event_items(spark, sf_dir), collections=["click", "error"], datetime="2024-01-03/2024-01-24", bbox=[-90, -45, 90, 45],
        intersects="POLYGON ((-120 -60, 60 -60, 60 40, -120 40, -120 -60))",
    )
    return found.select("id", "collection")


_KEY = "(s_suppkey * 37)"
_TYPE = "CASE s_suppkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'purchase' WHEN 3 THEN 'signup' ELSE 'error' END"
_SEARCHES = f"""se AS (SELECT s_suppkey AS search_id, CASE WHEN s_suppkey % 6 <> 0 THEN {_TYPE} END AS wanted, 10 + s_suppkey % 10 AS day,
    CAST({_KEY} % 359 AS DOUBLE) - CAST(179.5 AS DOUBLE) AS qx, CAST(({_KEY} // 7) % 169 AS DOUBLE) - CAST(84.75 AS DOUBLE) AS qy FROM supplier)"""


@query("q8_render_requests", f"""
    WITH {_SEARCHES} SELECT search_id, 'POST' AS method, '{{' || CASE WHEN wanted IS NULL THEN '' ELSE '"collections": ["' || wanted || '"], ' END
      || '"datetime": "2024-01-' || day || '/2024-01-' || (day + 10) || '", "bbox": [' || printf('%.10f', qx) || ', ' || printf('%.10f', qy) || ', '
      || printf('%.10f', qx + 20) || ', ' || printf('%.10f', qy + 10) || ']' || CASE WHEN search_id % 4 = 0 AND search_id % 100 > 0 THEN ', "limit": ' || (search_id % 100) ELSE '' END || '}}' AS body FROM se
    UNION ALL SELECT 1000000 + n_nationkey, 'POST', '{{"ids": ["x' || n_nationkey || '"], "intersects": {{"type": "Point", "coordinates": [' || printf('%.10f', CAST(n_nationkey AS DOUBLE))
      || ', 1.5000000000]}}, "limit": 5}}' FROM nation""")
def render_requests(spark, sf_dir):
    searches, k = landed(spark, sf_dir, "searches"), F.col("n_nationkey")
    more = table(spark, sf_dir, "nation").select(
        (F.lit(1000000) + k).cast("bigint").alias("search_id"), F.expr("cast(null as array<string>)").alias("collections"), F.array(F.concat(F.lit("x"), k)).alias("ids"),
        F.lit(None).cast("string").alias("datetime"), F.expr("cast(null as array<double>)").alias("bbox"), F.concat(F.lit("POINT ("), k, F.lit(" 1.5)")).alias("intersects"), F.lit(5).alias("max_items"),
    )
    return sky.render_requests(searches.unionByName(more))


# a search box may reach beyond 180 degrees; it is a plain range then
@query("q9_search_batch", f"""
    WITH {_EVENTS}, {_SEARCHES} SELECT search_id, id FROM se JOIN ev ON (wanted IS NULL OR event_type = wanted)
      AND ts >= make_timestamp(2024, 1, day, 0, 0, 0) AND ts < make_timestamp(2024, 1, day, 0, 0, 0) + INTERVAL 11 DAY
      AND minx <= qx + 20 AND maxx >= qx AND miny <= qy + 10 AND maxy >= qy""")
def search_batch(spark, sf_dir):
    return sky.search_batch(_event_items(spark, sf_dir), landed(spark, sf_dir, "searches").drop("max_items")).select("search_id", "id")


@query("q9_batch_ids", """
    SELECT DISTINCT s_suppkey AS search_id, 'ev-' || event_id AS id FROM supplier JOIN events ON event_id = s_suppkey * 7 OR event_id = s_suppkey * 11""")
def batch_ids(spark, sf_dir):
    k = F.col("s_suppkey")
    ids = F.array(F.concat(F.lit("ev-"), k * 7), F.concat(F.lit("ev-"), k * 11), F.lit("ev-none"))
    searches = table(spark, sf_dir, "supplier").select(k.alias("search_id"), ids.alias("ids"))
    return sky.search_batch(_event_items(spark, sf_dir, columns=["datetime"]), searches).select("search_id", "id")


def _type_searches(spark, sf_dir):
    types, k = F.array(*[F.lit(t) for t in sets.EVENT_TYPES]), F.col("r_regionkey")
    wanted = F.array(F.get(types, k), F.get(types, (k + 1) % 5))
    return table(spark, sf_dir, "region").where("r_regionkey < 5").select(k.alias("search_id"), wanted.alias("collections"), (F.lit(100) + k).alias("max_items"))


_TYPED = f"""t AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{t}')" for i, t in enumerate(sets.EVENT_TYPES))}) v(no, type)),
    wanted AS (SELECT r_regionkey AS search_id, 'ev-' || event_id AS id, 100 + r_regionkey AS page FROM region JOIN t ON no = r_regionkey OR no = (r_regionkey + 1) % 5
      JOIN events ON event_type = type)"""


@query("q9_batch_collections", f"WITH {_TYPED} SELECT search_id, id FROM wanted")
def batch_collections(spark, sf_dir):
    return sky.search_batch(_event_items(spark, sf_dir, columns=["datetime"]), _type_searches(spark, sf_dir).drop("max_items")).select("search_id", "id")


@query("q6_batch_pages", f"""
    WITH {_TYPED} SELECT search_id, id, CAST((row_number() OVER (PARTITION BY search_id ORDER BY id) - 1) // page AS BIGINT) AS page_no FROM wanted""")
def batch_pages(spark, sf_dir):
    return sky.search_batch(_event_items(spark, sf_dir, columns=["datetime"]), _type_searches(spark, sf_dir)).select("search_id", "id", "page_no")


# by time alone: spans of one to fourteen days, and one search in ten with an open end
@query("q9_batch_times", f"""
    WITH {_EVENTS}, s AS (SELECT s_suppkey AS search_id, make_timestamp(2024, 1, 1 + s_suppkey % 15, 0, 0, 0) AS lo,
      CASE WHEN s_suppkey % 10 > 0 THEN make_timestamp(2024, 1, 1 + s_suppkey % 15, 0, 0, 0) + to_days(CAST(1 + s_suppkey % 14 AS INTEGER)) END AS hi,
      CASE WHEN s_suppkey % 3 = 0 THEN 'view' END AS wanted FROM supplier)
    SELECT search_id, id FROM s JOIN ev ON ts >= lo AND (hi IS NULL OR ts < hi) AND (wanted IS NULL OR event_type = wanted)""")
def batch_times(spark, sf_dir):
    k = F.col("s_suppkey")
    day = 1 + k % 15
    text = F.concat(F.format_string("2024-01-%02d/", day), F.when(k % 10 > 0, F.format_string("2024-01-%02d", day + k % 14)).otherwise(".."))
    named = F.when(k % 3 == 0, F.array(F.lit("view"))).otherwise(F.expr("cast(array() as array<string>)"))
    searches = table(spark, sf_dir, "supplier").select(k.alias("search_id"), text.alias("datetime"), named.alias("collections"))
    return sky.search_batch(_event_items(spark, sf_dir, columns=["datetime"]), searches).select("search_id", "id")


_CITY = "CASE WHEN event_id % 10 < 3 THEN"
_CITY_BOX = f"""{_CITY} 11 + (event_id % 256) / 512.0::DOUBLE ELSE minx END AS x, {_CITY} 48 + (event_id // 256 % 128) / 256.0::DOUBLE ELSE miny END AS y,
    {_CITY} 0.001953125::DOUBLE ELSE 0.5::DOUBLE END AS w, {_CITY} 0.00390625::DOUBLE ELSE 0.25::DOUBLE END AS h"""


# three items of ten lie in half a degree; cells are split above 64 items
@query("q9_batch_crowded", f"""
    WITH {_EVENTS}, city AS (SELECT id, {_CITY_BOX} FROM ev),
    s AS (SELECT s_suppkey AS search_id, 10.75 + (s_suppkey % 40) / 32.0::DOUBLE AS qx, 47.75 + (s_suppkey % 30) / 32.0::DOUBLE AS qy, CASE WHEN s_suppkey % 4 = 0 THEN 1.0 ELSE 0.0625 END::DOUBLE AS size FROM supplier)
    SELECT search_id, id FROM s JOIN city ON x <= qx + size AND x + w >= qx AND y <= qy + size AND y + h >= qy""")
def batch_crowded(spark, sf_dir):
    items = _event_items(spark, sf_dir, columns=[]).withColumn("k", F.substring("id", 4, 20).cast("bigint"))
    k, inside = F.col("k"), F.col("k") % 10 < 3
    x, y = F.lit(11.0) + (k % 256) / 512.0, F.lit(48.0) + (F.floor(k / 256) % 128) / 256.0
    box = F.struct(x.alias("minx"), y.alias("miny"), (x + 0.001953125).alias("maxx"), (y + 0.00390625).alias("maxy"))
    items = items.select("id", "collection", F.when(inside, None).otherwise(F.col("geometry")).alias("geometry"), F.when(inside, box).otherwise(F.col("bbox")).alias("bbox"))
    s = F.col("s_suppkey")
    qx, qy, size = F.lit(10.75) + (s % 40) / 32.0, F.lit(47.75) + (s % 30) / 32.0, F.when(s % 4 == 0, 1.0).otherwise(0.0625)
    searches = table(spark, sf_dir, "supplier").select(s.alias("search_id"), F.array(qx, qy, qx + size, qy + size).alias("bbox"))
    return sky.search_batch(items, searches, crowded=64).select("search_id", "id")


@query("q9_batch_intersects", f"""
    WITH {_EVENTS}, s AS (SELECT n_nationkey AS search_id, CAST((n_nationkey * 13) % 300 AS DOUBLE) - 170.25 AS x, CAST((n_nationkey * 7) % 150 AS DOUBLE) - 80.25 AS y FROM nation)
    SELECT search_id, id FROM s JOIN ev ON minx <= x + 12 AND maxx >= x AND miny <= y + 6 AND maxy >= y""")
def batch_intersects(spark, sf_dir):
    k = F.col("n_nationkey")
    x, y = (k * 13 % 300).cast("double") - F.lit(170.25), (k * 7 % 150).cast("double") - F.lit(80.25)
    corner = F.format_string("%s %s", x, y), F.format_string("%s %s", x + 12, y), F.format_string("%s %s", x + 12, y + 6), F.format_string("%s %s", x, y + 6), F.format_string("%s %s", x, y)
    searches = table(spark, sf_dir, "nation").select(k.alias("search_id"), F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *corner), F.lit("))")).alias("intersects"))
    return sky.search_batch(_event_items(spark, sf_dir, columns=["datetime"]), searches).select("search_id", "id")


# -- filters, limits, counts -------------------------------------------------------------------------------------------


@query("f1_filter_complex", f"""
    WITH {_PLACED} SELECT id FROM placed WHERE (o_totalprice > 100000 AND o_orderstatus = 'F') OR (o_orderpriority = '1-URGENT' AND NOT o_totalprice > 200000 AND collection LIKE 'own-%')""")
def filter_complex(spark, sf_dir):
    items = _tree_items(spark, sf_dir, columns=["o:totalprice", "o:status", "o:urgent", "o:big"], fixed=["id", "collection"])
    return items.where("(`o:totalprice` > 100000 AND `o:status` = 'F') OR (`o:urgent` AND NOT `o:big` AND collection LIKE 'own-%')").select("id")


@query("f2_filter_property", f"WITH {_PLACED} SELECT id, collection, o_totalprice AS price FROM placed WHERE o_totalprice > 250000 AND o_orderpriority = '1-URGENT'")
def filter_property(spark, sf_dir):
    items = _tree_items(spark, sf_dir, columns=["o:totalprice", "o:urgent"], fixed=["id", "collection"])
    return items.where("`o:totalprice` > 250000 AND `o:urgent` IS NOT NULL").select("id", "collection", F.col("`o:totalprice`").alias("price"))


@query("f3_filter_struct_field", f"WITH {_PLACED} SELECT id, minx FROM placed WHERE minx > 1")
def filter_struct_field(spark, sf_dir):
    return _tree_items(spark, sf_dir, columns=[], fixed=["id", "bbox"]).where("bbox.minx > 1").select("id", F.col("bbox.minx").alias("minx"))


@query("l1_limit_rows", "SELECT 'ev-' || event_id AS id FROM events ORDER BY event_id LIMIT 50")
def limit_rows(spark, sf_dir):
    items = _event_items(spark, sf_dir, keep=["page_pos", "dfs_path"])
    return sky.crawl_order(items).limit(50).select("id")


@query("l2_offset_rows", "SELECT 'ev-' || event_id AS id FROM events ORDER BY event_id OFFSET 750")
def offset(spark, sf_dir):
    items = _event_items(spark, sf_dir, keep=["page_pos", "dfs_path"]).select("id", "page_pos", "dfs_path")
    return offset_rows(items, 750).select("id")


@query("l3_filtered_limit", "SELECT 'ev-' || event_id AS id, value FROM events WHERE value > 20 ORDER BY event_id LIMIT 25")
def filtered_limit(spark, sf_dir):
    items = _event_items(spark, sf_dir, keep=["page_pos", "dfs_path"])
    return sky.crawl_order(items.where("`eo:value` > 20")).limit(25).select("id", F.col("`eo:value`").alias("value"))


@query("l3_filtered_offset", "SELECT 'ev-' || event_id AS id FROM events WHERE event_type = 'click' ORDER BY event_id OFFSET 100")
def filtered_offset(spark, sf_dir):
    items = _event_items(spark, sf_dir, keep=["page_pos", "dfs_path"]).where("collection = 'click'").select("id", "page_pos", "dfs_path")
    return offset_rows(items, 100).select("id")


@query("l4_top_k", f"WITH {_PLACED} SELECT id, o_totalprice AS price FROM placed ORDER BY o_totalprice DESC, id LIMIT 20")
def top_k(spark, sf_dir):
    items = _tree_items(spark, sf_dir, columns=["o:totalprice"], fixed=["id"]).select("id", F.col("`o:totalprice`").alias("price"))
    return items.orderBy(F.desc("price"), "id").limit(20)


@query("l5_order_by_id", f"WITH {_PLACED} SELECT id FROM placed WHERE o_orderpriority = '1-URGENT' ORDER BY id")
def order_by_id(spark, sf_dir):
    return _tree_items(spark, sf_dir, columns=["o:urgent"], fixed=["id"]).where("`o:urgent`").select("id").orderBy("id")


@query("a1_count_items", f"""
    WITH {_PLACED} SELECT r_name AS catalog, count(*) AS n, count(id) AS n_ids FROM placed GROUP BY r_name
    UNION ALL SELECT '', count(*), count(event_id) FROM events""")
def count_items(spark, sf_dir):
    def count(items):
        return items.groupBy("catalog").agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("n_ids"))

    few = {"columns": [], "fixed": ["catalog", "id"]}
    return count(_tree_items(spark, sf_dir, **few)).unionByName(count(_event_items(spark, sf_dir, **few)))


@query("a2_matched_audit", f"""
    WITH {_EVENTS}, c AS (
      SELECT 'mem:/b/page-0.json' AS first_uri, count(*) AS number_matched, count(*) FILTER (p < 7) AS returned, count(DISTINCT p) FILTER (p < 7) AS n_pages FROM ev
      UNION ALL SELECT 'mem:/b/page-8.json', count(*), count(*) FILTER (p >= 8), count(DISTINCT p) FILTER (p >= 8) FROM ev)
    SELECT *, CAST(100 AS DOUBLE) * returned / number_matched AS percent, number_matched > 2048 AS is_large FROM c""")
def matched_audit(spark, sf_dir):
    # one page of the chain is lost, so that neither part returns all that its pages announce
    kept = landed(spark, sf_dir, "pages").where("doc_uri <> 'mem:/b/page-7.json'")
    return sky.matched_audit(sky.follow_pages(kept, ["mem:/b/page-0.json", "mem:/b/page-8.json"]))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the tree above a price: crawl, inherited ids, promoted properties, filter."""
    return filter_property(spark, sf_dir)
