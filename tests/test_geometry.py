import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from skyledger import geojson_to_wkt, make_envelope, wkt_to_geojson
from skyledger.functions import geometry as geo

TO_WKT = [
    ('{"type":"Point","coordinates":[1.0,2.50]}', "POINT (1 2.5)"),
    ('{"coordinates":[[1,2],[3,-4.25],[5,6,7]],"type":"LineString"}', "LINESTRING (1 2, 3 -4.25, 5 6)"),
    ('{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]],[[0.2,0.2],[0.3,0.2],[0.3,0.3],[0.2,0.2]]]}',
     "POLYGON ((0 0, 1 0, 1 1, 0 0), (0.2 0.2, 0.3 0.2, 0.3 0.3, 0.2 0.2))"),
    ('{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}', "MULTIPOINT ((1 2), (3 4))"),
    ('{"type":"MultiLineString","coordinates":[[[1,2],[3,4]],[[5,6],[7,8]]]}', "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8))"),
    ('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[2,2],[3,2],[3,3],[2,2]]]]}',
     "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((2 2, 3 2, 3 3, 2 2)))"),
    ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[1,2]},{"type":"GeometryCollection","geometries":'
     '[{"type":"LineString","coordinates":[[1,2],[3,4]]},{"type":"GeometryCollection","geometries":[]}]}]}',
     "GEOMETRYCOLLECTION (POINT (1 2), GEOMETRYCOLLECTION (LINESTRING (1 2, 3 4), GEOMETRYCOLLECTION EMPTY))"),
    ('{"type":"Polygon","coordinates":[]}', "POLYGON EMPTY"),
]
NO_GEOMETRY = [
    '{"type":"Point","coordinates":[1]}', '{"type":"Point","coordinates":["1","2"]}', '{"type":"Point","coordinates":[[1,2]]}',
    '{"type":"Blob","coordinates":[1,2]}', '{"coordinates":[1,2]}', '{"type":"Point"}', '{"type":"Point","coordinates":7}',
    '{"type":"Polygon","coordinates":[[]]}', '{"type":"LineString","coordinates":[1,2]}',
    '{"type":"GeometryCollection","geometries":[5]}', '{"type":"GeometryCollection"}',
]


def column(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, g string")


def test_geojson_to_wkt(spark):
    rows = geojson_to_wkt(column(spark, [g for g, _ in TO_WKT]), "g").orderBy("i").collect()
    assert [r["g"] for r in rows] == [w for _, w in TO_WKT]


def test_invalid_geojson(spark):
    lenient = geojson_to_wkt(column(spark, NO_GEOMETRY), "g", strict=False).collect()
    assert [r["g"] for r in lenient] == [None] * len(NO_GEOMETRY)
    for bad in NO_GEOMETRY[:4]:
        with pytest.raises(SparkRuntimeException, match="not a GeoJSON"):
            geojson_to_wkt(column(spark, [bad]), "g").collect()


def test_six_digits_like_a_default_stream(spark):
    numbers = [-7.1250345678912345, 123456.7891, 0.0000123456789, 99999.96, 1e-7, 0, -0.00012345678, 2500000.0, 51.234567891234567]
    rows = column(spark, ['{"type":"Point","coordinates":[%r,0]}' % n for n in numbers])
    got = [r["g"] for r in geojson_to_wkt(rows, "g", digits=6).orderBy("i").collect()]
    assert got == [f"POINT ({n:.6g} 0)" for n in numbers]


def test_long_geometry_does_not_exhaust_the_stack(spark):
    ring = ",".join(f"[{i % 180}.25,{i % 90}]" for i in range(20000))
    df = column(spark, ['{"type":"Polygon","coordinates":[[%s]]}' % ring, '{"type":"MultiPoint","coordinates":[%s]}' % ring])
    wkt = geojson_to_wkt(df, "g")
    back = wkt_to_geojson(wkt, "g").select("i", F.size(F.split("g", "\\], \\[")).alias("n")).orderBy("i").collect()
    assert [r["n"] for r in back] == [20000, 20000]


FROM_WKT = [
    ("POINT (1 2)", '{"type": "Point", "coordinates": [1.0000000000, 2.0000000000]}'),
    (" srid=4326; Point Z (1 2 3)", '{"type": "Point", "coordinates": [1.0000000000, 2.0000000000, 3.0000000000]}'),
    ("POINT ZM(1 2 3 4)", '{"type": "Point", "coordinates": [1.0000000000, 2.0000000000, 3.0000000000, 4.0000000000]}'),
    ("POINT M (1 2 3)", '{"type": "Point", "coordinates": [1.0000000000, 2.0000000000, 3.0000000000]}'),
    ("point empty", '{"type": "Point", "coordinates": []}'),
    ("LINESTRING(1e-7 2,3 4)", '{"type": "LineString", "coordinates": [[0.0000001000, 2.0000000000], [3.0000000000, 4.0000000000]]}'),
    ("MULTIPOINT (1 2, 3 4)", '{"type": "MultiPoint", "coordinates": [[1.0000000000, 2.0000000000], [3.0000000000, 4.0000000000]]}'),
    ("MULTIPOINT ((1 2), EMPTY)", '{"type": "MultiPoint", "coordinates": [[1.0000000000, 2.0000000000], null]}'),
    ("MULTILINESTRING (EMPTY, (1 2, 3 4))", '{"type": "MultiLineString", "coordinates": [[], [[1.0000000000, 2.0000000000], [3.0000000000, 4.0000000000]]]}'),
    ("GEOMETRYCOLLECTION EMPTY", '{"type": "GeometryCollection", "geometries": []}'),
    ("GEOMETRYCOLLECTION Z (POINT Z (1 2 3), GEOMETRYCOLLECTION Z (POINT Z EMPTY))",
     '{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1.0000000000, 2.0000000000, 3.0000000000]}, '
     '{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": []}]}]}'),
]
NO_WKT = [
    "POINT (1)", "BLOB (1 2)", "POINT (1 2", "POINT (1 2 3)", "LINESTRING ((1 2))", "POINT (a b)", "LINESTRING Z (1 2 3, 4 5)",
    "GEOMETRYCOLLECTION Z (POINT (1 2))", "POLYGON (1 2, 3 4)", "",
]


def test_wkt_to_geojson(spark):
    rows = wkt_to_geojson(column(spark, [w for w, _ in FROM_WKT]), "g").orderBy("i").collect()
    assert [r["g"] for r in rows] == [g for _, g in FROM_WKT]


def test_invalid_wkt(spark):
    lenient = wkt_to_geojson(column(spark, NO_WKT), "g", strict=False).collect()
    assert [r["g"] for r in lenient] == [None] * len(NO_WKT)
    with pytest.raises(SparkRuntimeException, match="not a WKT geometry"):
        wkt_to_geojson(column(spark, NO_WKT[:1]), "g").collect()


def test_round_trip(spark):
    there = geojson_to_wkt(column(spark, [g for g, _ in TO_WKT]), "g")
    again = geojson_to_wkt(wkt_to_geojson(there, "g"), "g").orderBy("i").collect()
    assert [r["g"] for r in again] == [w for _, w in TO_WKT]


def test_make_envelope_orders_corners(spark):
    box = spark.range(1).select(make_envelope(F.lit(3.0), F.lit(4.0), F.lit(1.0), F.lit(2.0)).alias("b")).first()["b"]
    assert tuple(box) == (1.0, 2.0, 3.0, 4.0)


FRAME = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"
MEETS_FRAME = [
    ("POINT (2 2)", False), ("POINT (1 1)", True), ("POINT (0.5 0.5)", True), ("POINT (5 5)", False),
    ("LINESTRING (1.5 1.5, 2.5 2.5)", False), ("LINESTRING (2 2, 9 9)", True), ("LINESTRING (0 5, 5 0)", True),
    ("POLYGON ((-1 -1, 9 -1, 9 9, -1 9, -1 -1))", True), ("POLYGON ((0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.1))", True),
    ("POLYGON ((4 4, 5 4, 5 5, 4 4))", True), ("POLYGON ((1.5 1.5, 2.5 1.5, 2.5 2.5, 1.5 1.5))", False),
    ("POLYGON ((4 -1, 4.5 -1, 4.5 5, 4 5, 4 -1))", True), ("POLYGON ((4.1 -1, 4.5 -1, 4.5 5, 4.1 5, 4.1 -1))", False),
    ("MULTIPOINT (9 9, 0 0)", True), ("MULTIPOINT ((9 9), (2 2))", False), ("MULTIPOLYGON (((8 8, 9 8, 9 9, 8 8)), ((3.5 3.5, 3.6 3.5, 3.6 3.6, 3.5 3.5)))", True),
    ("GEOMETRYCOLLECTION (POINT (9 9), GEOMETRYCOLLECTION (POINT (0.5 2)))", True), ("POINT EMPTY", False),
]


def test_geom_intersects(spark):
    frame, extent = geo.shape_literal(spark, F.lit(FRAME))
    assert extent == (0.0, 0.0, 4.0, 4.0)
    df = spark.createDataFrame(MEETS_FRAME, "w string, expected boolean")
    shape = geo.shape_of_wkt(F.col("w"))
    rows = df.select("w", "expected", geo.geom_intersects(shape, frame).alias("ab"), geo.geom_intersects(frame, shape).alias("ba")).collect()
    assert [(r["w"], r["ab"], r["ba"]) for r in rows] == [(w, e, e) for w, e in MEETS_FRAME]


def test_triangles_against_separating_axes(spark):
    """Random triangles and rectangles; for convex shapes two are apart exactly when an edge direction separates them."""
    rng = random.Random(5)

    def apart(a, b):
        for shape in (a, b):
            for (x0, y0), (x1, y1) in zip(shape, shape[1:] + shape[:1]):
                nx, ny = y1 - y0, x0 - x1
                pa, pb = [nx * x + ny * y for x, y in a], [nx * x + ny * y for x, y in b]
                if max(pa) < min(pb) or max(pb) < min(pa):
                    return True
        return False

    def wkt(points):
        return "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in points + points[:1]) + "))"

    rows = []
    for _ in range(300):
        t = [(rng.randint(0, 20) / 2, rng.randint(0, 20) / 2) for _ in range(3)]
        (x0, y0), (x1, y1), (x2, y2) = t
        if (x1 - x0) * (y2 - y0) == (y1 - y0) * (x2 - x0):
            continue
        x, y, w, h = rng.randint(0, 18) / 2, rng.randint(0, 18) / 2, rng.randint(1, 6) / 2, rng.randint(1, 6) / 2
        r = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        rows.append((wkt(t), wkt(r), not apart(t, r)))
    df = spark.createDataFrame(rows, "a string, b string, expected boolean")
    wrong = df.where(geo.geom_intersects(geo.shape_of_wkt(F.col("a")), geo.shape_of_wkt(F.col("b"))) != F.col("expected"))
    assert wrong.collect() == []
    assert len({e for _, _, e in rows}) == 2


def test_bbox_overlap_across_the_antimeridian(spark):
    boxes = [(170, 0, -170, 1), (-175, 0, -172, 1), (0, 0, 1, 1), (175, 0, 180, 1), (160, 5, -160, 9), (-170, 1, -160, 2)]

    def spans(b):
        return [(b[0], b[2])] if b[0] <= b[2] else [(b[0], 180), (-180, b[2])]

    def overlap(a, b):
        return a[1] <= b[3] and a[3] >= b[1] and any(s[0] <= t[1] and s[1] >= t[0] for s in spans(a) for t in spans(b))

    pairs = [(tuple(map(float, a)), tuple(map(float, b)), overlap(a, b)) for a in boxes for b in boxes]
    box = "struct<minx:double,miny:double,maxx:double,maxy:double>"
    df = spark.createDataFrame(pairs, f"a {box}, b {box}, expected boolean")
    assert df.where(geo.bbox_overlaps(F.col("a"), F.col("b")) != F.col("expected")).collect() == []


def star(rng, x, y, size, n, jagged=0.4):
    """A ring of n points around a place, jagged."""
    import math

    far = [size * rng.uniform(1 - jagged, 1) for _ in range(n)]
    ring = [(round(x + r * math.cos(k / n * math.tau), 4), round(y + r * math.sin(k / n * math.tau), 4)) for k, r in enumerate(far)]
    return "(" + ", ".join(f"{a} {b}" for a, b in [*ring, ring[0]]) + ")"


def test_bands_agree_with_all_edges(spark):
    """Geometries of many edges, with holes, parts, overlapping polygons, lines and points, against the plain test of shapes."""
    rng = random.Random(6)
    comb = "(" + ", ".join(f"{k / 10} {(k % 2) * 20}" for k in range(200)) + ", 20 -1, 0 -1, 0 0)"
    large = [
        f"POLYGON ({star(rng, 0, 0, 20, 400)}, {star(rng, 0, 0, 6, 90)})",
        f"MULTIPOLYGON (({star(rng, 0, 0, 10, 100)}), ({star(rng, 5, 5, 10, 80)}), ({star(rng, -12, 8, 1, 30)}))",
        f"GEOMETRYCOLLECTION (LINESTRING {star(rng, 2, 2, 9, 300)}, POINT (15 15), POLYGON ({star(rng, -9, -9, 3, 20)}))",
        f"POLYGON ({comb})", "LINESTRING (" + ", ".join(f"{k / 7} 3" for k in range(-99, 99)) + ")",
        "MULTIPOINT (" + ", ".join(f"{k % 13} {k % 7}" for k in range(100)) + ")",
    ]
    small = [f"POINT ({rng.randint(-44, 44) / 2} {rng.randint(-44, 44) / 2})" for _ in range(80)] + [f"POINT ({k % 13} {k % 7})" for k in range(5)]
    small += [f"POLYGON ({star(rng, rng.uniform(-25, 25), rng.uniform(-25, 25), rng.choice([0.1, 1, 5, 40]), 5)})" for _ in range(80)]
    small += ["LINESTRING (-50 0, 50 0)", "POLYGON ((-90 -90, 90 -90, 90 90, -90 90, -90 -90))", "POINT EMPTY", "MULTIPOLYGON (((14 14, 16 14, 16 16, 14 16, 14 14)))"]
    df = spark.createDataFrame([(w,) for w in small], "w string").select("w", geo.shape_of_wkt(F.col("w")).alias("s")).cache()
    for wkt in large:
        test, extent = geo.shape_test(spark, F.lit(wkt))
        plain, same = geo.shape_literal(spark, F.lit(wkt))
        rows = df.select("w", test(F.col("s")).alias("got"), geo.geom_intersects(F.col("s"), plain).alias("expected")).collect()
        assert extent == same and [r["w"] for r in rows if r["got"] != r["expected"]] == [], wkt[:40]
        assert len({r["expected"] for r in rows}) == 2


def test_bands_hold_few_edges(spark):
    for n in (500, 50_000):
        _, shape, extent = geo._parsed(spark, F.lit(f"POLYGON ({star(random.Random(7), 0, 0, 50, n, 1 / n)})"))
        _, bands, cut = geo._cut_bands(shape, extent[1], extent[3])
        # what a point looks at does not grow with the number of edges
        assert sum(len(b) for b in cut["bands"]) <= geo.ENTRIES * n and sum(len(b) for b in cut["bands"]) / bands < 150


def test_a_long_coastline_plans_at_once(spark):
    import math
    import time

    ring = [(round(40 * math.cos(k / 25000 * math.tau), 6), round(40 * math.sin(k / 25000 * math.tau), 6)) for k in range(25000)]
    wkt = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + "))"
    boxes = spark.createDataFrame([("in", "POINT (1 1)"), ("out", "POINT (50 0)"), ("edge", "LINESTRING (39 0, 41 0)")], "id string, wkt string")
    began = time.time()
    shape, _ = geo.shape_literal(spark, F.lit(wkt))
    found = boxes.where(geo.geom_intersects(geo.shape_of_wkt(F.col("wkt")), shape))
    found._jdf.queryExecution().executedPlan()
    assert time.time() - began < 20
    assert sorted(r["id"] for r in found.collect()) == ["edge", "in"]


def test_a_shape_is_worked_out_once(spark):
    """The plan of the test reads the text of each shape in one place; shapes apart are told by their extents."""
    df = spark.createDataFrame([("POINT (2 2)", False), ("POLYGON ((0 5, 5 0, 9 9, 0 5))", True), ("POINT (99 99)", False), (None, None)], "w string, expected boolean")
    frame, _ = geo.shape_literal(spark, F.lit(FRAME))
    got = df.select("w", "expected", geo.geom_intersects(geo.shape_of_wkt(F.col("w")), frame).alias("got"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1
    assert [(r["w"], r["got"]) for r in got.collect()] == [(r["w"], r["expected"]) for r in got.collect()]


@pytest.mark.parametrize("wkt", [
    "POINT (1.5 -2)", "LINESTRING (0 0, 1e2 1)", "LINESTRING (3 4)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
    "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((8 8, 9 8, 9 9, 8 8), (8.5 8.5, 8.6 8.5, 8.6 8.6, 8.5 8.5)))",
])
def test_plain_text_has_the_shape_of_any_other(spark, wkt):
    """The short way for text as this library writes it and the way for any text agree."""
    df = spark.createDataFrame([(wkt, wkt.lower().replace("(", " ( ").replace(",", " , "))], "plain string, other string")
    row = df.select(F.col("plain").rlike(geo._PLAIN_WKT).alias("p"), F.col("other").rlike(geo._PLAIN_WKT).alias("o"), geo.shape_of_wkt(F.col("plain")).alias("a"), geo.shape_of_wkt(F.col("other")).alias("b")).first()
    assert row["p"] and not row["o"] and row["a"] == row["b"] and row["a"]["segments"]


@pytest.mark.parametrize("geometry", [
    '{"type":"Polygon","coordinates":[[[0,0],[4.50,0],[4,4.0],[0,0]],[[1,1],[2,1],[2,2],[1,1]]]}', '{"type":"MultiPolygon","coordinates":[[[[0,0],[4,0],[4,4],[0,0]]],[[[8,8],[9,8],[9,9],[8,8]],[[8.5,8.5],[8.6,8.5],[8.6,8.6],[8.5,8.5]]]]}',
    '{"type":"MultiPolygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]]]}', '{"type":"Polygon","coordinates":[[0,0],[4,0]]}', '{"type":"Polygon","coordinates":[[[0,0,7],[4,0,7],[0,0,7]]]}',
])
def test_plain_areas_have_the_wkt_of_any_other(spark, geometry):
    df = spark.createDataFrame([(geometry,)], "g string").select(F.from_json("g", geo.GEOJSON_PARTS).alias("p"))
    row = df.select(geo._simple_wkt(F.col("p.type"), F.col("p.coordinates"), None).alias("a"), geo._any_wkt(F.col("p.type"), F.col("p.coordinates"), None).alias("b")).first()
    assert row["a"] == row["b"] and (row["a"] is None) == ("MultiPolygon" in geometry and "[[[[" not in geometry or "[[[" not in geometry)
