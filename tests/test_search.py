import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import skyledger as sky
from skyledger.operators import order
from skyledger.sources.responses import freshest_response

ITEM = "collection string, id string, geometry string, bbox struct<minx:double,miny:double,maxx:double,maxy:double>, datetime string, start_datetime string, end_datetime string"


def rectangle(b):
    x0, y0, x1, y1 = b
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def make_items(spark, rows):
    return spark.createDataFrame(rows, ITEM)


@pytest.fixture(scope="module")
def timed(spark):
    when = {
        "noon": ("2024-03-10T12:00:00Z", None, None), "late": ("2024-03-10T23:59:59.999999Z", None, None), "next": ("2024-03-11T00:00:00Z", None, None),
        "east": ("2024-03-11T01:30:00+02:00", None, None), "plain": ("2024-03-10T08:00:00", None, None), "bad": ("soon", None, None),
        "span": (None, "2024-03-01T00:00:00Z", "2024-03-20T00:00:00Z"), "before": (None, "2024-02-01T00:00:00Z", "2024-03-09T00:00:00Z"), "none": (None, None, None),
    }
    return make_items(spark, [("c", k, "POINT (0 0)", (0.0, 0.0, 0.0, 0.0), *v) for k, v in when.items()])


@pytest.mark.parametrize("text, expected", [
    ("2024-03-10", "noon late east plain span"), ("2024-03-10/2024-03-10", "noon late east plain span"),
    ("2024-03-10T12:00:00Z", "noon span"), ("2024-03-10T14:00:00+02:00", "noon span"),
    ("../2024-03-10T12:00:00Z", "noon plain span before"), ("2024-03-10T23:59:59.999999Z/..", "late next span"),
    ("2024-03-11/", "next span"), ("2024-03-09/2024-03-09", "span before"), ("../..", "noon late next east plain span before"),
])
def test_datetime(timed, text, expected):
    assert {r["id"] for r in sky.search(timed, datetime=text).collect()} == set(expected.split())


@pytest.mark.parametrize("text", ["yesterday", "..", "2024-03-10/2024-03-11/2024-03-12", "10.03.2024"])
def test_bad_datetime(timed, text):
    with pytest.raises(ValueError):
        sky.search(timed, datetime=text)


@pytest.fixture(scope="module")
def placed(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        size = rng.choice([0.0, 0.5, 0.5, 3.0, 20.0, 100.0])
        x, y = rng.randint(-360, 360 - int(2 * size)) / 2, rng.randint(-180, 180 - int(2 * min(size, 80))) / 2
        b = (x, y, min(x + size, 180.0), min(y + min(size, 80), 90.0))
        rows.append((rng.choice("abc"), f"i{i}", rectangle(b), b, f"2024-01-{1 + i % 28:02d}T00:00:00Z", None, None))
    rows.append(("a", "crossing", "MULTIPOLYGON (((178 0, 180 0, 180 5, 178 5, 178 0)), ((-180 0, -178 0, -178 5, -180 5, -180 0)))", (178.0, 0.0, -178.0, 5.0), "2024-01-05T00:00:00Z", None, None))
    rows.append(("a", "nowhere", None, None, "2024-01-05T00:00:00Z", None, None))
    rows.append(("a", "boxed", None, (10.0, 10.0, 11.0, 11.0), "2024-01-05T00:00:00Z", None, None))
    return rows


SEARCHES = [
    {"bbox": [0, 0, 10, 10]}, {"bbox": [-180, -90, 180, 90]}, {"bbox": [170, -20, -160, 20]}, {"bbox": [10.25, 10.25, 10.25, 10.25]},
    {"bbox": [-50, -50, -49.5, -49.5], "collections": ["a", "b"]}, {"collections": ["c"], "datetime": "2024-01-03/2024-01-09"}, {"ids": ["i3", "crossing", "nowhere"]},
    {"intersects": "POLYGON ((0 0, 60 0, 0 60, 0 0))"}, {"intersects": "POINT (10.5 10.5)"}, {"intersects": "POINT EMPTY"}, {"datetime": "2024-01-05"},
    {"bbox": [0, 0, 40, 40], "intersects": "LINESTRING (-10 -10, 50 50)", "datetime": "../2024-01-20"}, {"bbox": [160, -90, 200, 90]},
]


def expected(rows, s):
    """Brute force; footprints are rectangles, so boxes and separating axes decide."""

    def spans(b):
        return [(b[0], b[2])] if b[0] <= b[2] else [(b[0], 180), (-180, b[2])]

    def boxes(a, b):
        return a is not None and a[1] <= b[3] and a[3] >= b[1] and any(s[0] <= t[1] and s[1] >= t[0] for s in spans(a) for t in spans(b))

    def meets(b, wkt):
        if wkt.startswith("POINT ("):
            x, y = map(float, wkt[7:-1].split())
            return boxes(b, (x, y, x, y))
        if wkt.startswith("POLYGON"):
            return any(s <= 60 and t >= 0 and max(s, 0) + max(b[1], 0) <= 60 for s, t in spans(b)) and boxes(b, (0, 0, 60, 60)) if b else False
        if wkt.startswith("LINESTRING"):
            return b is not None and any(max(s, b[1], -10) <= min(t, b[3], 50) for s, t in spans(b))
        return False

    out = set()
    for c, i, _, b, when, _, _ in rows:
        day = when[:10]
        ok = c in s["collections"] if s.get("collections") else True
        ok = ok and (i in s["ids"] if s.get("ids") else True)
        if "bbox" in s:
            ok = ok and boxes(b, s["bbox"])
        if "intersects" in s:
            ok = ok and meets(b, s["intersects"])
        if "datetime" in s:
            ends = (s["datetime"].split("/") * 2)[:2]
            ok = ok and (ends[0] == ".." or day >= ends[0]) and day <= ends[1]
        if ok:
            out.add(i)
    return out


def test_search_against_brute_force(spark, placed):
    items = make_items(spark, placed).cache()
    for s in SEARCHES:
        assert {r["id"] for r in sky.search(items, **s).collect()} == expected(placed, s), s


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_search_batch_against_brute_force(spark, placed, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        check_batch(spark, placed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def check_batch(spark, placed):
    rows = [(n, s.get("collections"), s.get("ids"), s.get("datetime"), [float(v) for v in s["bbox"]] if "bbox" in s else None, s.get("intersects")) for n, s in enumerate(SEARCHES)]
    searches = spark.createDataFrame(rows, "search_id int, collections array<string>, ids array<string>, datetime string, bbox array<double>, intersects string")
    got = [(r["search_id"], r["id"]) for r in sky.search_batch(make_items(spark, placed), searches).select("search_id", "id").collect()]
    assert len(got) == len(set(got))
    for n, s in enumerate(SEARCHES):
        assert {i for k, i in got if k == n} == expected(placed, s), s


def test_footprints_are_worked_out_once(spark):
    """Triangles, rectangles and a path along three corners against boxes and shapes: as one search finds them. Items are read once for searches with and without collections,
    their footprint before they meet searches, and not at all where no search has a shape."""
    rng = random.Random(12)
    rows = []
    for i in range(90):
        x, y, w, h = rng.randint(-40, 40) / 2, rng.randint(-40, 40) / 2, rng.randint(1, 12) / 2, rng.randint(1, 12) / 2
        wkt = [rectangle((x, y, x + w, y + h)), f"POLYGON (({x} {y}, {x + w} {y}, {x} {y + h}, {x} {y}))", f"LINESTRING ({x} {y}, {x + w} {y}, {x + w} {y + h}, {x + w} {y}, {x} {y})"][i % 3]
        rows.append((rng.choice("ab"), f"i{i}", wkt, (x, y, x + w, y + h), "2024-01-05T00:00:00Z", None, None))
    items = make_items(spark, rows).cache()
    asked = [{"bbox": [float(x), float(y), x + rng.choice([0.0, 1.0, 9.0]), y + 3.0], "collections": ["a"] if n % 2 else None} for n, (x, y) in enumerate((rng.randint(-20, 20), rng.randint(-20, 20)) for _ in range(16))]
    table = spark.createDataFrame([(n, s["bbox"], s["collections"]) for n, s in enumerate(asked)], "search_id int, bbox array<double>, collections array<string>")
    found = sky.search_batch(items, table).select("search_id", "id")
    assert sorted(tuple(r) for r in found.collect()) == sorted((n, r["id"]) for n, s in enumerate(asked) for r in sky.search(items, **s).select("id").collect())
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(found).count("InMemoryRelation") == 1 and plan(found).count("upper(") == 1
    days = spark.createDataFrame([(1, "2024-01-05", ["a"]), (2, "2024-01-05", None)], "search_id int, datetime string, collections array<string>")
    assert "geometry" not in plan(sky.search_batch(items, days).select("search_id", "id")).split("InMemoryRelation")[0]


def test_times_without_boxes_meet_in_buckets(spark):
    """Instants and spans of all lengths against searches of all lengths, open ends among them; the plan joins on buckets of time."""
    rng = random.Random(8)
    start = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)

    def span(longest):
        a = start + dt.timedelta(minutes=rng.randint(0, 3_000_000))
        return a, a + dt.timedelta(minutes=rng.choice([0, rng.randint(0, 30), rng.randint(0, longest)]))

    text = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    rows, items = [], {}
    for i in range(500):
        a, b = span(500_000)
        items[f"i{i}"] = (rng.choice("ab"), a, b)
        rows.append((items[f"i{i}"][0], f"i{i}", None, None, text(a) if a == b else None, None if a == b else text(a), None if a == b else text(b)))
    rows.append(("a", "never", None, None, None, None, None))
    searches, asked = [], []
    for n in range(60):
        a, b = span(2_000_000)
        a, b = (None, b) if n % 9 == 0 else (a, None) if n % 9 == 1 else (a, b)
        named = ["a"] if n % 3 == 0 else []
        searches.append((n, named, None, f"{text(a) if a else '..'}/{text(b) if b else '..'}", None, None))
        asked.append((n, named, a, b))
    # a wide box and a time: by time as well
    found = sky.search_batch(make_items(spark, rows), spark.createDataFrame(searches, BATCH).drop("max_items"))
    got = [(r["search_id"], r["id"]) for r in found.collect()]
    wanted = {(n, i) for n, named, a, b in asked for i, (c, first, last) in items.items() if (not named or c in named) and (b is None or first <= b) and (a is None or last >= a)}
    assert len(got) == len(set(got)) and set(got) == wanted
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan and "_cx" not in plan


def test_times_alone_are_one_join(spark):
    """Where no search has a shape, pairs meet in their bucket of time and nothing else is joined to them, with collections and without."""
    rows = [("ab"[k % 2], f"i{k}", None, None, f"2024-01-{1 + k:02d}T00:00:00Z", None, None) for k in range(20)]
    searches = spark.createDataFrame([(n, f"2024-01-05/2024-01-{5 + n:02d}", ["a"] if n % 2 else None) for n in range(6)], "search_id int, datetime string, collections array<string>")
    found = sky.search_batch(make_items(spark, rows), searches).select("search_id", "id")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
    wanted = [(n, f"i{k}") for n in range(6) for k in range(4, 5 + n) if n % 2 == 0 or k % 2 == 0]
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)


def test_crowded_cells_are_split(spark):
    """Three items of ten lie in a town; its cell is split, no node keeps more small items than allowed, and no pair is lost or found twice."""
    rng = random.Random(9)
    boxes = {}
    for i in range(900):
        if i % 10 < 3:
            x, y, size = 11 + rng.random() / 4, 48 + rng.random() / 4, rng.choice([0.0, 0.001, 0.01])
        else:
            x, y, size = rng.uniform(-180, 170), rng.uniform(-90, 80), rng.choice([0.0, 0.3, 1.0, 9.0])
        boxes[f"i{i}"] = (x, y, x + size, y + size)
    boxes |= {f"big{i}": (10.5 + i / 100, 47.5, 12.0, 49.0) for i in range(5)} | {"edge": (179.9, 89.9, 180.0, 90.0)}
    asked = {n: (x, y, x + s, y + s) for n, (x, y, s) in enumerate([(rng.uniform(10.5, 11.5), rng.uniform(47.5, 48.5), rng.choice([0.0, 0.01, 0.1, 1.0, 5.0])) for _ in range(60)])}
    asked[100], asked[101] = (-180.0, -90.0, 180.0, 90.0), (170.0, 80.0, 190.0, 95.0)
    items = make_items(spark, [("a", k, None, b, None, None, None) for k, b in boxes.items()])
    searches = spark.createDataFrame([(n, list(b)) for n, b in asked.items()], "search_id int, bbox array<double>")
    wanted = {(n, k) for n, q in asked.items() for k, b in boxes.items() if b[0] <= q[2] and b[2] >= q[0] and b[1] <= q[3] and b[3] >= q[1]}
    for crowded in (8, None):
        got = [(r["search_id"], r["id"]) for r in sky.search_batch(items, searches, crowded=crowded).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted, crowded


def test_searches_of_crowded_cells_are_dealt_out(spark):
    """The table of searches is a small file; where cells are split its rows are dealt over tasks by number, and a search meets each item once."""
    items = make_items(spark, [("a", f"i{k}", None, (11 + k / 64, 48.0, 11 + k / 64, 48.0), None, None, None) for k in range(16)])
    searches = spark.createDataFrame([(n, [11.0, 47.5, 11 + n / 64, 48.5]) for n in range(5)], "search_id int, bbox array<double>")
    found = sky.search_batch(items, searches, crowded=2).select("search_id", "id")
    assert "RepartitionByExpression [q_no" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == sorted((n, f"i{k}") for n in range(5) for k in range(n + 1))


def test_nodes_hold_few_items(spark):
    from skyledger.operators import meeting, search
    from skyledger.workspace import Workspace

    rng = random.Random(10)
    points = [(0, 0, 191, 138, (11 + rng.random() / 50, 48 + rng.random() / 50), 20) for _ in range(600)]
    rows = [(level, depth, nx, ny, (x, y, x, y), deep) for level, depth, nx, ny, (x, y), deep in points]
    placed = spark.createDataFrame(rows, "_level int, _depth int, _nx bigint, _ny bigint, box struct<minx:double,miny:double,maxx:double,maxy:double>, deep int")
    nodes = meeting.crowded_nodes(placed, "box", "deep", search._size_of, 20, Workspace(spark))
    assert nodes.agg(F.max("_depth")).first()[0] > 6  # down to a hundredth of a degree
    ended = meeting.items_in_nodes(placed, nodes, "box", "deep", search._size_of)
    counts = [r["count"] for r in ended.groupBy(*meeting.NODE).count().collect()]
    assert sum(counts) >= 600 and max(counts) <= 20


BATCH = "search_id int, collections array<string>, ids array<string>, datetime string, intersects string, max_items int"


@pytest.mark.parametrize(("datetime", "wkt", "message"), [
    ("yesterday", None, "search 7: datetime"), ("a/b/c", None, "search 7: datetime"), ("2024-02-31/2024-03-03", None, "search 7: datetime"), ("..", None, "search 7: datetime"),
    (None, "POINT (1)", "search 7: not a WKT geometry"),
])
def test_batch_raises_for_what_cannot_be_read(spark, placed, datetime, wkt, message):
    searches = spark.createDataFrame([(1, ["a"], None, None, None, None), (7, None, None, datetime, wkt, None)], BATCH)
    with pytest.raises(Exception, match=message):
        sky.search_batch(make_items(spark, placed), searches).collect()


def test_batch_pages_and_ways(spark, placed):
    items = make_items(spark, placed)
    searches = spark.createDataFrame([(1, ["a"], None, None, None, 7), (2, None, ["i3", "i3", "nowhere"], "", None, 1), (3, None, None, None, None, 5), (4, ["b"], None, None, None, -1)], BATCH)
    got = [(r["search_id"], r["id"], r["page_no"]) for r in sky.search_batch(items, searches).collect()]
    for n, s, size in ((1, {"collections": ["a"]}, 7), (2, {"ids": ["i3", "nowhere"]}, 1), (3, {}, None), (4, {"collections": ["b"]}, None)):
        ids = sorted(expected(placed, s))
        assert sorted((i, p) for k, i, p in got if k == n) == [(i, k // size if size else None) for k, i in enumerate(ids)]
    only = sky.search_batch(items, searches.where("search_id = 2").drop("max_items"))
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "_cx" not in plan  # ids are joined on the id
    assert sky.search_batch(items, searches.limit(0)).collect() == []


def test_search_arguments(spark, placed):
    items = make_items(spark, placed)
    for wrong in ("yesterday", "2024-02-31", "2024-01-01T25:00:00Z", "a/b/c", ".."):
        with pytest.raises(ValueError, match="datetime"):
            sky.search(items, datetime=wrong)
    with pytest.raises(ValueError, match="four numbers"):
        sky.search(items, bbox=[1, 2, 3])
    with pytest.raises(ValueError, match="not a WKT geometry"):
        sky.search(items, intersects="POINT (1)")
    assert sky.search(items, collections=[], ids=[], datetime="").count() == len(placed)
    assert sky.search(items, bbox=[0, 10, 10, 0]).count() == sky.search(items, bbox=[0, 0, 10, 10]).count()
    assert "page_no" not in sky.search(items, max_items=5).columns
    assert "page_no" not in sky.search(items, collections=["a"], max_items=-5).columns
    many = [f"i{n}" for n in range(0, 400, 2)] + [f"x{n}" for n in range(2000)]
    found = sky.search(items, ids=many)
    assert found.count() == 200 and found.columns == items.columns


def test_a_million_ids(spark, placed, tmp_path):
    """A long list is planned at once; its ends reach the scan, the list itself is a join."""
    import time

    sky.store_items(make_items(spark, placed), str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    ids = [f"i{k}" for k in range(0, 2_000_000, 2)]
    began = time.time()
    found = sky.search(items, ids=ids)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert time.time() - began < 20  # some 2 s on an idle machine
    assert "GreaterThanOrEqual(id,i0)" in plan and "LeftSemi" in plan and len(plan) < 20_000
    assert found.columns == items.columns
    assert {r["id"] for r in found.collect()} == {f"i{k}" for k in range(0, 400, 2)}


def test_pages_and_offsets_with_ties(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.format_string("k%04d", "id")).alias("id"))
    paged = order.number_pages(rows, 100).groupBy("page_no").count().orderBy("page_no").collect()
    assert [(r["page_no"], r["count"]) for r in paged] == [(p, 100) for p in range(10)]
    ordered = sorted(r["id"] for r in rows.collect())
    assert sorted(r["id"] for r in order.offset_rows(rows, 300, ("id",)).collect()) == ordered[300:]


def test_render_requests(spark):
    rows = [
        (1, ["a", 'b"c'], [], "2021-09-30/..", [3.0, 2.0, 1.5, -1.0], None, 10), (2, None, None, None, None, None, 5), (3, [], ["x"], "", None, "POINT (1 2)", -1),
    ]
    searches = spark.createDataFrame(rows, "search_id int, collections array<string>, ids array<string>, datetime string, bbox array<double>, intersects string, max_items int")
    got = {r["search_id"]: (r["method"], r["body"]) for r in sky.render_requests(searches).collect()}
    assert got == {
        1: ("POST", '{"collections": ["a", "b\\"c"], "datetime": "2021-09-30/..", "bbox": [3.0000000000, -1.0000000000, 1.5000000000, 2.0000000000], "limit": 10}'),
        2: ("GET", None),
        3: ("POST", '{"ids": ["x"], "intersects": {"type": "Point", "coordinates": [1.0000000000, 2.0000000000]}}'),
    }


RESPONSE = "url string, method string, headers map<string,string>, content_type string, body_sent string, status int, fetched_at timestamp, body string"


def test_freshest_response_against_a_plain_walk(spark):
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    rows, kept = [], set()
    for url in "abcd":
        at, last = 0.0, None
        for n in range(120):
            at += rng.choice([0.5, 3, 10, 29, 30, 31, 70, 400])
            rows.append((url, rng.choice(["get", "GET"]), {"x": "1", "y": "2"} if n % 2 else {"y": "2", "x": "1"}, None, "", 200, start + dt.timedelta(seconds=at), f"{url}{n}"))
            if last is None or at - last > 30:
                last = at
                kept.add(f"{url}{n}")
    rows += [("a", "GET", {}, None, "", 500, start, "failed"), ("a", "PUT", {}, None, "", 200, start, "put")]
    df = spark.createDataFrame(rows, RESPONSE)
    assert {r["body"] for r in freshest_response(df).collect()} == kept | {"put"}
    assert freshest_response(df, 0).count() == len(rows) - 1  # a failed response is none


def test_different_requests_have_different_keys(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("u", "POST", {"b": "2"}, None, "x\na:1", 200, at, "1"), ("u", "POST", {"a": "1", "b": "2"}, None, "x", 200, at + dt.timedelta(seconds=1), "2"), ("u", "post", {"b": "2", "a": "1"}, "", "x", 200, at + dt.timedelta(seconds=2), "3")]
    assert sorted(r["body"] for r in freshest_response(spark.createDataFrame(rows, RESPONSE)).collect()) == ["1", "2"]


def test_response_documents(spark):
    df = spark.createDataFrame([("u", "GET", {}, None, "", 200, dt.datetime(2024, 1, 1), "{}"), ("v", "GET", {}, None, "", 404, dt.datetime(2024, 1, 1), None)], RESPONSE)
    assert [tuple(r) for r in sky.response_documents(df, "drop").collect()] == [("u", "{}")]
    assert [tuple(r) for r in sky.response_documents(df, "report").collect()] == [("v", 404)]
    again = df.unionByName(spark.createDataFrame([("u", "GET", {}, None, "", 200, dt.datetime(2024, 1, 2), "{2}"), ("v", "GET", {}, None, "", 200, dt.datetime(2024, 1, 2), "{3}")], RESPONSE))
    assert sorted(tuple(r) for r in sky.response_documents(again, latest=True).collect()) == [("u", "{2}"), ("v", "{3}")]
    with pytest.raises(Exception, match="response for 'v' has status 404"):
        sky.response_documents(df).collect()


def test_stored_items_are_pruned(spark, placed, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    path = str(tmp_path / "items")
    sky.store_items(make_items(spark, placed), path, 4)
    stored = spark.read.parquet(path)
    found = sky.search(stored, collections=["a"], datetime="2024-01-03/2024-01-09", bbox=[0, 0, 90, 90])
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("EqualTo(collection,a)", "LessThan(datetime,2024-01-12)", "LessThanOrEqual(bbox.miny,90.0)", "GreaterThanOrEqual(bbox.maxx,0.0)", "EqualTo(crosses_antimeridian,true)"):
        assert part in pushed
    assert {r["id"] for r in found.collect()} == expected(placed, {"collections": ["a"], "datetime": "2024-01-03/2024-01-09", "bbox": [0, 0, 90, 90]})
