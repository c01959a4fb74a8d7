"""Catalog documents derived from the driver's tables, see FIXTURES.md.

Documents are landed once per session as a table in the shared folder, as a harvested catalog would be, and every query reads
them from there. A container lists at most FAN children; longer lists are cut into index documents, as deep as the keys need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.workspace import Workspace

FAN = 4096
PAGE = 100
RESPONSE_TTL = 3600

_landed: dict[tuple, tuple] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of SETS as a written table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        df = SETS[name](spark, sf_dir)
        # spread by key: the tables are small files, and a document is worth far more work than the row it comes from
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path, _ = Workspace(spark).write(df.repartition(n, df.columns[0]), name)
        _landed[key] = (path, df.schema)
    path, schema = _landed[key]
    return spark.read.schema(schema).parquet(path)


# -- pieces of JSON ----------------------------------------------------------------------------------------------------


def text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def num(c: Column) -> Column:
    return c.cast("string")


def quoted(c: Column) -> Column:
    return text('"', c, '"')


def json_text(c: Column) -> Column:
    """A string as JSON with its escapes."""
    listed = F.to_json(F.array(c))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def position(k: Column) -> tuple[Column, Column]:
    lon = (k % 359).cast("double") - F.lit(179.5)
    lat = (F.floor(k / 7) % 169).cast("double") - F.lit(84.75)
    return lon, lat


def corners(k: Column) -> list[Column]:
    lon, lat = position(k)
    return [lon, lat, lon + F.lit(0.5), lat + F.lit(0.25)]


def array_text(*numbers: Column) -> Column:
    return text("[", F.concat_ws(",", *[num(n) for n in numbers]), "]")


def rectangle(k: Column) -> Column:
    x0, y0, x1, y1 = corners(k)
    ring = [array_text(x0, y0), array_text(x1, y0), array_text(x1, y1), array_text(x0, y1), array_text(x0, y0)]
    return text('{"type":"Polygon","coordinates":[[', F.concat_ws(",", *ring), "]]}")


def feature(fid: Column, properties: Column, geometry: Column, bbox: Column, collection: Column, links=None, assets=None, extensions=None) -> Column:
    links = links if links is not None else F.lit('[{"rel":"root","href":"/catalog.json","type":"application/json"}]')
    assets = assets if assets is not None else F.lit("{}")
    extensions = extensions if extensions is not None else F.lit("[]")
    return text(
        '{"type":"Feature","id":', quoted(fid), ',"properties":{', properties, '},"geometry":', geometry, ',"links":', links,
        ',"assets":', assets, ',"bbox":', bbox, ',"stac_extensions":', extensions,
        F.when(collection.isNull(), "").otherwise(text(',"collection":', quoted(collection))), "}",
    )


def link(rel: str, href: Column) -> Column:
    return text('{"rel":"', rel, '","href":', quoted(href), "}")


def container(kind: str, cid: Column, links: Column) -> Column:
    return text('{"type":"', kind, '","id":', quoted(cid), ',"links":[', links, "]}")


def _listed(group: DataFrame, order: str) -> Column:
    """Links of one container in order; a container has at most FAN of them."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "link"))), lambda s: s["link"]), ",")


def index_documents(children: DataFrame, keys: list[str], max_key: int, kind: str) -> tuple[DataFrame, list[DataFrame]]:
    """Containers over the dense key ``k`` of ``children`` (keys, base, name, k, href), FAN children to a container.

    Returns the topmost entries (keys, base, name, k, href) for the container above, and the index documents.
    """
    documents = []
    level = 0
    entries = children
    while level == 0 or max_key // FAN ** level >= FAN:
        level += 1
        rows = entries.withColumn("g", F.floor(F.col("k") / FAN)).withColumn("link", link("item" if level == 1 else "child", F.col("href")))
        groups = rows.groupBy(*keys, "base", "name", "g").agg(_listed(rows, "k").alias("links"))
        uri = text(F.col("base"), f"/idx/l{level}-", num(F.col("g")), ".json")
        documents.append(groups.select(uri.alias("doc_uri"), container(kind, F.col("name"), F.col("links")).alias("body")))
        entries = groups.select(*keys, "base", "name", F.col("g").alias("k"), text(f"l{level}-", num(F.col("g")), ".json").alias("href"))
    return entries.withColumn("href", text("./idx/", F.col("href"))), documents


def _max(df: DataFrame, name: str) -> int:
    return df.agg(F.max(name)).first()[0] or 0


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- set A: a tree -----------------------------------------------------------------------------------------------------


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def order_feature() -> Column:
    k = F.col("o_orderkey")
    properties = F.concat_ws(
        ",",
        text('"datetime":"', F.date_format("o_orderdate", "yyyy-MM-dd"), 'T00:00:00Z"'),
        text('"o:totalprice":', num(F.col("o_totalprice"))),
        text('"o:cust":', num(F.col("o_custkey"))),
        text('"o:status":', quoted(F.col("o_orderstatus"))),
        text('"o:priority":', quoted(F.col("o_orderpriority"))),
        text('"o:big":', num(F.col("o_totalprice") > 200000)),
        text('"o:dims":[', num(k % 7), ",", num(k % 11), "]"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit('"o:urgent":true')),
        F.lit('"o:note":null'),
    )
    links = text(
        '[{"rel":"root","href":"/a/catalog.json","type":"application/json"},{"rel":"self","href":"./', num(k), '.json","title":"order ',
        num(k), '"},{"rel":"license"},7]',
    )
    assets = text(
        '{"data":{"href":"s3://o/', num(k), '.tif","type":"image/tiff","roles":["data",5],"bands":[1]},"thumb":{"href":"t/', num(k),
        '.png","title":"thumb","description":"small"},"bad":{"type":"x"},"worse":3}',
    )
    extensions = text('["ext:', num(k % 3), '",5,"proj"]')
    collection = F.when(k % 2 == 0, text("own-", F.col("o_orderstatus")))
    return feature(text("o-", num(k)), properties, rectangle(k), array_text(*corners(k)), collection, links, assets, extensions)


def tree(spark: SparkSession, sf_dir: str, back_links: bool = False) -> DataFrame:
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    placed = placed_orders(spark, sf_dir)
    base = text("mem:/a/r", num(F.col("n_regionkey")), "/n", num(F.col("n_nationkey")))
    item_documents = placed.select(text(base, "/items/", num(F.col("o_orderkey")), ".json").alias("doc_uri"), order_feature().alias("body"))
    children = placed.select(
        "n_nationkey", "n_regionkey", base.alias("base"), F.col("n_name").alias("name"), F.col("o_orderkey").alias("k"),
        text("../items/", num(F.col("o_orderkey")), ".json").alias("href"),
    )
    top, index = index_documents(children, ["n_nationkey", "n_regionkey"], _max(table(spark, sf_dir, "orders"), "o_orderkey"), "Collection")
    if back_links:
        # a catalog that links back to its root from every index document
        index = [d.withColumn("body", F.regexp_replace("body", r"\]\}$", ',{"rel":"child","href":"../../../catalog.json"}]}')) for d in index]
    rows = top.withColumn("link", link("child", F.col("href")))
    nations = rows.groupBy("n_nationkey", "n_regionkey", "base", "name").agg(_listed(rows, "k").alias("links"))
    nations = nations.select(
        text(F.col("base"), "/collection.json").alias("doc_uri"),
        container("Collection", F.col("name"), text('{"rel":"parent","href":"../catalog.json"},', F.col("links"))).alias("body"),
    )
    of_region = nation.select("n_regionkey", F.col("n_nationkey").alias("k"), link("child", text("./n", num(F.col("n_nationkey")), "/collection.json")).alias("link"))
    regions = of_region.groupBy("n_regionkey").agg(_listed(of_region, "k").alias("links")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    regions = regions.select(
        text("mem:/a/r", num(F.col("r_regionkey")), "/catalog.json").alias("doc_uri"),
        container("Catalog", F.col("r_name"), text('{"rel":"parent","href":"../catalog.json"},', F.col("links"))).alias("body"),
    )
    of_root = region.select(F.col("r_regionkey").alias("k"), link("child", text("./r", num(F.col("r_regionkey")), "/catalog.json")).alias("link"))
    root = of_root.agg(_listed(of_root, "k").alias("links")).select(
        F.lit("mem:/a/catalog.json").alias("doc_uri"),
        container("Catalog", F.lit("world"), text('{"rel":"root","href":"./catalog.json"},{"rel":"self","href":"./catalog.json"},', F.col("links"))).alias("body"),
    )
    return _union([root, regions, nations, *index, item_documents])


# -- set B: pages ------------------------------------------------------------------------------------------------------


def event_feature() -> Column:
    k = F.col("event_id")
    properties = F.concat_ws(
        ",",
        text('"datetime":"', F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z"'),
        text('"user:id":', num(F.col("user_id"))),
        text('"eo:value":', num(F.col("value"))),
        text('"raw":', F.col("props")),
    )
    return feature(text("ev-", num(k)), properties, rectangle(k), array_text(*corners(k)), F.col("event_type"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    n, last = events.agg(F.count(F.lit(1)), F.max(F.floor(F.col("event_id") / PAGE))).first()
    rows = events.select(F.floor(F.col("event_id") / PAGE).alias("p"), "event_id", event_feature().alias("link"))
    grouped = rows.groupBy("p").agg(_listed(rows, "event_id").alias("features"))
    onward = text(
        ',{"rel":"next","href":"./page-', num(F.col("p") + 1), '.json","method":"', F.when(F.col("p") % 2 == 0, "GET").otherwise("POST"),
        '","merge":', num(F.col("p") % 2 == 1), ',"headers":{"x-page":"', num(F.col("p") + 1), '","n":1},"body":{"token":', num(F.col("p") + 1), "}}",
    )
    links = text('{"rel":"self","href":"./page-', num(F.col("p")), '.json"}', F.when(F.col("p") < (last or 0), onward).otherwise(""))
    page = text('{"type":"FeatureCollection","numberMatched":', str(n), ',"features":[', F.col("features"), '],"links":[', links, "]}")
    documents = grouped.select(text("mem:/b/page-", num(F.col("p")), ".json").alias("doc_uri"), page.alias("body"))
    root = spark.range(1).select(
        F.lit("mem:/b/collection.json").alias("doc_uri"), container("Collection", F.lit("stream"), link("items", F.lit("./page-0.json"))).alias("body")
    )
    return root.unionByName(documents)


# -- set C: geometries -------------------------------------------------------------------------------------------------


def geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, geometry): one GeoJSON geometry per part."""
    k = F.col("p_partkey")
    x, y = position(k)

    def at(dx, dy):
        return array_text(x + F.lit(float(dx)), y + F.lit(float(dy)))

    def ring(*points):
        return text("[", F.concat_ws(",", *[at(*p) for p in points]), "]")

    square, inner = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], [(0.5, 0.5), (0.75, 0.5), (0.75, 0.75), (0.5, 0.5)]
    far = [(4, 4), (5, 4), (5, 5), (4, 4)]
    polygon = F.when(k % 14 == 2, text("[", ring(*square), ",", ring(*inner), "]")).otherwise(text("[", ring(*square), "]"))

    def geometry(kind, coords):
        return text('{"type":"', kind, '","coordinates":', coords, "}")

    point, line = geometry("Point", at(0, 0)), geometry("LineString", ring((0, 0), (1, 0.5), (2, 0.25)))
    kinds = [
        point, line, geometry("Polygon", polygon), geometry("MultiPoint", ring((0, 0), (1, 1))),
        geometry("MultiLineString", text("[", ring((0, 0), (1, 0)), ",", ring((0, 1), (1, 1)), "]")),
        geometry("MultiPolygon", text("[[", ring(*square), "],[", ring(*far), "]]")),
        text('{"type":"GeometryCollection","geometries":[', point, ",", line, "]}"),
    ]
    chosen = F.lit(None).cast("string")
    for i, g in enumerate(kinds):
        chosen = F.when(k % 7 == i, g).otherwise(chosen)
    return table(spark, sf_dir, "part").select("p_partkey", chosen.alias("geometry"))


# -- set D: defects ----------------------------------------------------------------------------------------------------


def defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    k, fault = F.col("c_custkey"), F.col("c_custkey") % 12

    def unless(n, t):
        return F.when(fault != n, t if isinstance(t, Column) else F.lit(t))

    x0, y0, x1, y1 = corners(k)
    whole = F.floor(k / 12) % 100
    bbox = (
        F.when(fault == 4, array_text(whole, whole + 1, whole + 2, whole + 3))
        .when(fault == 5, array_text(x0, y0, F.lit(-5.5), x1, y1, F.lit(7.25)))
        .otherwise(array_text(x0, y0, x1, y1))
    )
    properties = F.concat_ws(
        ",",
        text('"d:mixed":', F.when(k % 2 == 0, num(k)).otherwise(num(k + F.lit(0.5)))),
        text('"d:any":', F.when(k % 3 == 0, num(k)).otherwise(quoted(F.col("c_name")))),
        F.when(fault == 11, F.lit('"d:late":true')),
    )
    assets = F.when(fault == 7, F.lit('{"a":{"type":"x"},"b":5,"c":{"href":"c"}}')).otherwise(F.lit('{"c":{"href":"c"}}'))
    links = F.when(fault == 8, F.lit('[{"rel":"self","href":"x"},{"href":"y"}]')).otherwise(F.lit('[{"rel":"self","href":"x"},{"rel":"z","href":"y"}]'))
    body = text("{", F.concat_ws(
        ",",
        unless(9, '"type":"Feature"'), unless(1, text('"id":"c-', num(k), '"')),
        text('"properties":{', properties, "}"), text('"geometry":', F.when(fault == 2, F.lit("null")).otherwise(rectangle(k))),
        unless(3, text('"bbox":', bbox)), unless(6, '"stac_extensions":["e",5]'), text('"links":', links), text('"assets":', assets),
    ), "}")
    items = customer.select(
        text("mem:/d/items/", num(k), ".json").alias("doc_uri"), F.when(fault == 10, F.lit("{not json")).otherwise(body).alias("body")
    )
    children = customer.select(
        F.lit("mem:/d").alias("base"), F.lit("customers").alias("name"), k.alias("k"), text("../items/", num(k), ".json").alias("href")
    )
    top, index = index_documents(children, [], _max(customer, "c_custkey"), "Collection")
    rows = top.withColumn("link", link("child", F.col("href")))
    root = rows.agg(_listed(rows, "k").alias("links")).select(
        F.lit("mem:/d/catalog.json").alias("doc_uri"), container("Catalog", F.lit("defects"), F.col("links")).alias("body")
    )
    return _union([root, *index, items])


# -- set E: searches ---------------------------------------------------------------------------------------------------

EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    lon, lat = position(k * 37)
    day = F.lit(10) + k % 10
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    return table(spark, sf_dir, "supplier").select(
        k.alias("search_id"),
        F.when(k % 6 == 0, F.expr("cast(array() as array<string>)")).otherwise(F.array(F.get(types, (k % 5).cast("int")))).alias("collections"),
        F.expr("cast(null as array<string>)").alias("ids"),
        text("2024-01-", num(day), "/2024-01-", num(day + 10)).alias("datetime"),
        F.array(lon, lat, lon + F.lit(20.0), lat + F.lit(10.0)).alias("bbox"),
        F.lit(None).cast("string").alias("intersects"),
        F.when(k % 4 == 0, (k % 100).cast("int")).alias("max_items"),
    )


# -- set F: responses --------------------------------------------------------------------------------------------------


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.col("event_id")
    a, b = (F.lit("accept"), F.lit("json")), (F.lit("x-key"), F.lit("1"))
    return events.select(
        text("mem:/f/", F.col("event_type"), "/", num(F.col("user_id") % 20)).alias("url"),
        F.when(k % 2 == 0, "get").otherwise("GET").alias("method"),
        F.when(k % 3 == 0, F.create_map(*a, *b)).otherwise(F.create_map(*b, *a)).alias("headers"),
        F.lit("application/json").alias("content_type"), F.lit("").alias("body_sent"),
        F.when(k % 17 == 0, 503).otherwise(200).alias("status"), F.col("ts").alias("fetched_at"),
        text('{"event":', num(k), "}").alias("body"),
    )


# -- set G: repeated keys ----------------------------------------------------------------------------------------------


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A root catalog with a collection for each nation and an item for each customer; links, properties, nested values and assets repeat keys, of which the last counts."""
    customer = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    # quotes, a backslash, blanks, a line end and letters outside ASCII
    plain = F.concat(F.lit(' "'), F.col("c_mktsegment"), F.lit('" \\ ü\n'), num(k % 7), F.lit(" 漢"))
    properties = text('"g:twice":"first","g:twice":', num(k), ',"g:nested":{"k":1,"k":', num(k), '},"g:plain":', json_text(plain))
    assets = text('{"a":{"href":"old"},"a":{"href":"x","href":"a-', num(k), '"},"b":{"href":"b"}}')
    links = F.lit('[{"rel":"self","rel":"self","href":"x"}]')
    items = customer.select(
        text("mem:/g/items/", num(k), ".json").alias("doc_uri"),
        feature(text("g-", num(k)), properties, rectangle(k), array_text(*corners(k)), F.lit(None).cast("string"), links=links, assets=assets).alias("body"),
    )
    wrong = text('{"rel":"item","href":"nowhere.json","href":', quoted(text("items/", num(k), ".json")), "}")
    rows = customer.withColumn("link", wrong)
    nations = rows.groupBy("c_nationkey").agg(_listed(rows, "c_custkey").alias("links")).select(
        text("mem:/g/n", num(F.col("c_nationkey")), ".json").alias("doc_uri"), container("Collection", text("n", num(F.col("c_nationkey"))), F.col("links")).alias("body")
    )
    heads = customer.select("c_nationkey").distinct().withColumn("link", link("child", text("n", num(F.col("c_nationkey")), ".json")))
    root = heads.agg(_listed(heads, "c_nationkey").alias("links")).select(F.lit("mem:/g/catalog.json").alias("doc_uri"), container("Catalog", F.lit("repeats"), F.col("links")).alias("body"))
    return _union([root, nations, items])


# -- set H: a mesh of catalogs and a circle of pages ---------------------------------------------------------------------


def mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog for each nation that links to the catalogs of all nations and to an item for each supplier; and a page for each nation, the last followed by the first."""
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    k = F.col("n_nationkey")
    every = nation.withColumn("link", link("child", text("c", num(k), ".json")))
    every = every.agg(_listed(every, "n_nationkey").alias("all"), F.count(F.lit(1)).alias("n"))  # one row
    rows = supplier.withColumn("link", link("item", text("items/", num(F.col("s_suppkey")), ".json")))
    listed = rows.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(_listed(rows, "s_suppkey").alias("own"))
    nations = nation.join(listed, "n_nationkey", "left").crossJoin(F.broadcast(every))
    catalogs = nations.select(text("mem:/h/c", num(k), ".json").alias("doc_uri"), container("Catalog", F.col("n_name"), F.concat_ws(",", "all", "own")).alias("body"))
    pages = nations.select(
        text("mem:/h/page-", num(k), ".json").alias("doc_uri"),
        text('{"type":"FeatureCollection","features":[],"links":[', link("next", text("page-", num((k + 1) % F.col("n")), ".json")), "]}").alias("body"),
    )
    s = F.col("s_suppkey")
    items = supplier.select(
        text("mem:/h/items/", num(s), ".json").alias("doc_uri"),
        feature(text("h-", num(s)), F.lit('"datetime":"2024-01-01T00:00:00Z"'), rectangle(s), array_text(*corners(s)), F.lit(None).cast("string")).alias("body"),
    )
    return _union([catalogs, pages, items])


SETS = {
    "tree": tree, "pages": pages, "geometries": geometries, "defects": defects, "searches": searches, "responses": responses, "repeats": repeats, "mesh": mesh,
}
