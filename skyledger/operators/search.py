"""Searching the item table by collection, id, time, box and geometry; one search as a predicate, many as a grid join."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import let, once
from skyledger.functions.geometry import (
    bbox_overlaps, envelope_wkt, extent_of, fills_extent, geojson_of_wkt, geom_intersects, parse_envelope, shape_of_wkt, shape_test,
)
from skyledger.operators.meeting import (
    TIME_SIZES, crowded_nodes, deepest_node, items_by_time, items_in_nodes, meet_in_nodes, meet_in_time, searches_by_time, searches_in_nodes, span_of, time_level,
)
from skyledger.operators.order import number_pages, number_rows
from skyledger.workspace import Workspace

_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})?$"


# -- time --------------------------------------------------------------------------------------------------------------


def instant(text: Column) -> Column:
    """Timestamp of RFC 3339 text; a date is its first moment, a time without offset is UTC, anything else NULL."""
    up = F.upper(text)
    zoned = F.when(up.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & ~up.rlike(_DATE), up).otherwise(F.concat(up, F.lit("Z")))
    full = F.when(text.rlike(_DATE), F.concat(text, F.lit("T00:00:00Z"))).when(text.rlike(_TIME), F.replace(zoned, F.lit(" "), F.lit("T")))
    return full.try_cast("timestamp")


def _last_moment(text: Column) -> Column:
    # a day of 24 hours, whatever the clocks of the session's time zone do
    whole_day = F.timestamp_micros(F.unix_micros(instant(text)) + 86_399_999_999)
    return F.when(text.rlike(_DATE), whole_day).otherwise(instant(text))


def datetime_range(text: Column) -> Column:
    """Struct (lo, hi) of an instant, a date (its whole day) or ``a/b``; an open end ('' or '..') is NULL. Closed on both sides."""
    start, end = F.get(F.split(text, "/"), F.lit(0)), F.coalesce(F.get(F.split(text, "/"), F.lit(1)), F.get(F.split(text, "/"), F.lit(0)))
    return F.struct(instant(start).alias("lo"), _last_moment(end).alias("hi"))


def _is_instant(text: str) -> bool:
    """Whether this is a date or a time that exists."""
    if not re.match(_DATE, text) and not re.match(_TIME, text):
        return False
    try:
        return bool(dt.datetime.fromisoformat(text.upper().replace(" ", "T")))
    except ValueError:
        return False


def check_datetime(text: str) -> str:
    parts = text.split("/")
    valid = all(p in ("", "..") or _is_instant(p) for p in parts)
    if not valid or len(parts) > 2 or (len(parts) == 1 and parts[0] in ("", "..")):
        raise ValueError(f"datetime is neither an instant nor an interval: {text!r}")
    return text


def _item_times(names: list[str]) -> tuple[Column, Column]:
    """First and last moment of an item: its datetime, else its start and end; columns the items lack count as NULL."""

    def column(name):
        return instant(F.col(f"`{name}`").cast("string")) if name in names else F.lit(None).cast("timestamp")

    at, start, end = column("datetime"), column("start_datetime"), column("end_datetime")
    return F.coalesce(at, start, end), F.coalesce(at, end, start)


def _in_range(first: Column, last: Column, rng: Column) -> Column:
    not_after = rng["hi"].isNull() | (first <= rng["hi"])
    return not_after & (rng["lo"].isNull() | (last >= rng["lo"])) & first.isNotNull()


def _datetime_condition(names: list[str], text: str) -> Column:
    check_datetime(text)
    first, last = _item_times(names)
    exact = _in_range(first, last, datetime_range(F.lit(text)))
    if "datetime" not in names:
        return exact
    # A coarse bound on the text itself, one day wider than any offset can shift it: it reaches the scan of a stored table.
    ends = (text.split("/") * 2)[:2]
    at = F.col("datetime").cast("string")
    coarse = []
    if ends[0] not in ("", ".."):
        coarse.append(at >= F.date_format(F.date_sub(F.lit(ends[0][:10]).cast("date"), 2), "yyyy-MM-dd"))
    if ends[1] not in ("", ".."):
        coarse.append(at < F.date_format(F.date_add(F.lit(ends[1][:10]).cast("date"), 3), "yyyy-MM-dd"))
    if not coarse:
        return exact
    return (at.isNull() | reduce(lambda a, b: a & b, coarse)) & exact


# -- space -------------------------------------------------------------------------------------------------------------


def _box_literal(box: tuple[float, float, float, float]) -> Column:
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(("minx", "miny", "maxx", "maxy"), box)])


def _box_prefilter(box: tuple[float, float, float, float], names: list[str]) -> Column:
    """Overlap with a known box; the parts on single fields reach the scan of a stored table."""
    minx, miny, maxx, maxy = box
    b = F.col("bbox")
    if minx > maxx:
        return bbox_overlaps(b, _box_literal(box))
    along_y = (b["miny"] <= F.lit(maxy)) & (b["maxy"] >= F.lit(miny))
    inside = (b["minx"] <= F.lit(maxx)) & (b["maxx"] >= F.lit(minx))
    crossing = (b["minx"] > b["maxx"]) & ((b["minx"] <= F.lit(maxx)) | (b["maxx"] >= F.lit(minx)))
    exact = along_y & (inside | crossing)
    return (inside | F.col("crosses_antimeridian")) & exact if "crosses_antimeridian" in names else exact


def _footprint_meets(test: Callable[[Column], Column]) -> Column:
    # an item without a footprint is judged by its box alone
    return let(F.col("geometry"), lambda wkt: F.when(wkt.isNull(), True).otherwise(test(shape_of_wkt(wkt))))


def _geometry_conditions(items: DataFrame, wkt: Column) -> tuple[Column, Column]:
    """(box test, footprint test) for a search geometry."""
    test, extent = shape_test(items.sparkSession, wkt)
    if extent is None:
        return F.lit(False), F.lit(False)
    return _box_prefilter(extent, items.columns), _footprint_meets(test)


# -- lists ---------------------------------------------------------------------------------------------------------------

#: values of a list that a plan spells out; a longer list is written and joined
LONG_LIST = 1000


def _listed(items: DataFrame, name: str, values: list[str]) -> DataFrame:
    """Items whose column is in a long list. Its ends reach the scan of a stored table; the rest is a semi join with a written table, for which Spark may
    send the list to the items, or a Bloom filter of it."""
    known = [v for v in values if v is not None]
    table = items.sparkSession.createDataFrame(pa.table({"_wanted": pa.array(known, pa.string())}))
    wanted, _ = Workspace(items.sparkSession).materialize(table, "list")
    # byte order of UTF-8 is code point order
    ends = F.col(name).between(F.lit(min(known, default="")), F.lit(max(known, default="")))
    return items.where(ends).join(wanted, F.col(name) == F.col("_wanted"), "left_semi")


# -- one search --------------------------------------------------------------------------------------------------------


def search(
    items: DataFrame, collections=None, ids=None, datetime: str | None = None, bbox=None, intersects: str | None = None,
    max_items: int | None = None,
) -> DataFrame:
    """Items that meet all criteria given; an empty list, '' or None is no criterion.

    ``datetime`` is an instant, a date or ``start/end`` with open ends; ``bbox`` four numbers [minx, miny, maxx, maxy], crossing the
    antimeridian when minx > maxx; ``intersects`` a WKT geometry. Time and boxes are inclusive. ``max_items`` is a page size: all
    rows come, with their ``page_no`` in order of id; it means nothing when it is the only criterion.
    """
    conditions = []
    result = items
    for name, values in (("collection", collections), ("id", ids)):
        wanted = list(dict.fromkeys(values or []))
        if len(wanted) > LONG_LIST:
            result = _listed(result, name, wanted)
        elif wanted:
            conditions.append(F.col(name).isin(wanted))
    if datetime:
        conditions.append(_datetime_condition(items.columns, datetime))
    exact = []
    if bbox is not None:
        box = parse_envelope(bbox)
        conditions.append(_box_prefilter(box, items.columns))
        exact.append(_geometry_conditions(items, envelope_wkt(_box_literal(box)))[1])
    if intersects is not None:
        near, meets = _geometry_conditions(items, F.lit(intersects))
        conditions.append(near)
        exact.append(meets)
    # cheap tests first, footprints last
    for condition in [*conditions, *exact]:
        result = result.where(condition)
    has_criterion = bool(conditions or exact or collections or ids)
    if max_items and max_items > 0 and has_criterion:
        return number_pages(result, max_items)
    return result


# -- requests ----------------------------------------------------------------------------------------------------------


def render_requests(searches: DataFrame) -> DataFrame:
    """Searches as API requests: (search_id, method, body). A search without criteria is a GET without a body."""

    def quoted(text: Column) -> Column:
        listed = F.to_json(F.array(text))
        return F.substr(listed, F.lit(2), F.length(listed) - 2)

    def strings(name: str) -> Column:
        parts = F.array_join(F.transform(F.col(name), quoted), ", ")
        return F.when(F.size(name) > 0, F.concat(F.lit(f'"{name}": ['), parts, F.lit("]")))

    datetime = F.when(F.col("datetime") != "", F.concat(F.lit('"datetime": '), quoted(F.col("datetime"))))
    b = F.col("bbox")
    order = [b[0], F.least(b[1], b[3]), b[2], F.greatest(b[1], b[3])]
    numbers = F.concat_ws(", ", *[F.format_string("%.10f", n) for n in order])
    wrong = F.raise_error(F.lit("bbox needs four numbers: minx, miny, maxx, maxy"))
    bbox = F.when(F.size("bbox") == 4, F.concat(F.lit('"bbox": ['), numbers, F.lit("]"))).when(b.isNotNull(), wrong)
    geometry = F.coalesce(geojson_of_wkt(F.col("intersects")), F.raise_error(F.concat(F.lit("not a WKT geometry: "), F.col("intersects"))))
    intersects = F.when(F.col("intersects").isNotNull(), F.concat(F.lit('"intersects": '), geometry))
    criteria = F.concat_ws(", ", strings("collections"), strings("ids"), datetime, bbox, intersects)
    limit = F.when(F.col("max_items") > 0, F.concat(F.lit('"limit": '), F.col("max_items").cast("string")))
    body = F.when(F.col("criteria") != "", F.concat(F.lit("{"), F.concat_ws(", ", "criteria", limit), F.lit("}")))
    rendered = searches.withColumn("criteria", criteria)
    return rendered.select("search_id", F.when(F.col("criteria") != "", "POST").otherwise("GET").alias("method"), body.alias("body"))


# -- many searches -----------------------------------------------------------------------------------------------------

# Cell sizes in degrees, finest first; the last one has one cell for the whole globe.
CELL_SIZES = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 512.0]
#: from this level on a box says less than a time
WIDE = 7
#: items above which a cell is split, and searches from which on cells are counted for it; fewer are small enough to be sent to the items
CROWDED, MANY_SEARCHES = 100_000, 10_000


def _level(box: Column) -> Column:
    """The finest grid whose cells are at least as large as the box, so that the box touches at most four of them."""
    extent = F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"])
    level = F.lit(len(CELL_SIZES) - 1)
    for i in range(len(CELL_SIZES) - 2, -1, -1):
        level = F.when(extent <= CELL_SIZES[i], i).otherwise(level)
    return level


def _cell_index(v: Column, low: float, size: Column) -> Column:
    span = -2 * low
    last = F.floor((F.lit(span) - F.lit(1e-9)) / size)
    return F.least(F.greatest(F.floor((v - F.lit(low)) / size), F.lit(0)), last).cast("int")


def _size_of(level: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in CELL_SIZES]), level)


def _effective(box: Column) -> Column:
    """Box for the grid: the whole globe when there is none, all longitudes when it crosses the antimeridian."""
    crossing = box["minx"] > box["maxx"]
    full = F.struct(F.lit(-180.0).alias("minx"), F.lit(-90.0).alias("miny"), F.lit(180.0).alias("maxx"), F.lit(90.0).alias("maxy"))
    return F.when(box.isNull(), full).otherwise(
        F.struct(
            F.when(crossing, -180.0).otherwise(box["minx"]).alias("minx"), box["miny"].alias("miny"),
            F.when(crossing, 180.0).otherwise(box["maxx"]).alias("maxx"), box["maxy"].alias("maxy"),
        )
    )


def _with_cells(rows: DataFrame, prefix: str, levels: Column) -> DataFrame:
    """One row per grid cell touched, on each of the levels, with the first cell of its box there (``fx``, ``fy``). One step that Spark doesn't compile together with
    what follows: the JVM leaves methods alone that are too long, and pairs are then walked by its interpreter."""
    box = F.col(f"{prefix}_eff")

    def on_level(level):
        size = _size_of(level)
        ends = F.struct(
            _cell_index(box["minx"], -180.0, size).alias("x0"), _cell_index(box["maxx"], -180.0, size).alias("x1"),
            _cell_index(box["miny"], -90.0, size).alias("y0"), _cell_index(box["maxy"], -90.0, size).alias("y1"),
        )

        def touched(e):
            def cell(x, y):
                return F.struct(level.alias("level"), x.alias("cx"), y.alias("cy"), e["x0"].alias("fx"), e["y0"].alias("fy"))

            return F.flatten(F.transform(F.sequence(e["x0"], e["x1"]), lambda x: F.transform(F.sequence(e["y0"], e["y1"]), lambda y: cell(x, y))))

        return let(ends, touched)

    rows = rows.withColumn("_at", F.explode(F.flatten(F.transform(levels, on_level))))
    names = {"_level": "level", "_cx": "cx", "_cy": "cy", f"{prefix}_fx": "fx", f"{prefix}_fy": "fy"}
    return rows.withColumns({name: F.col(f"_at.{field}") for name, field in names.items()}).drop("_at")


def _search_table(searches: DataFrame) -> DataFrame:
    """Searches (search_id, collections, ids, datetime, bbox, intersects; all but the first may be absent), parsed once."""
    names = searches.columns

    def column(name, ddl):
        return F.col(name).cast(ddl) if name in names else F.lit(None).cast(ddl)

    def fault(what: str, value: Column, ddl: str) -> Column:
        return F.raise_error(F.format_string(f"search %s: {what}: %s", F.col("search_id").cast("string"), value.cast("string"))).cast(ddl)

    bbox, wkt, text = column("bbox", "array<double>"), column("intersects", "string"), column("datetime", "string")
    box_type = "struct<minx:double,miny:double,maxx:double,maxy:double>"
    box = F.when(F.size(bbox) == 4, F.struct(
        F.get(bbox, F.lit(0)).alias("minx"), F.least(F.get(bbox, F.lit(1)), F.get(bbox, F.lit(3))).alias("miny"),
        F.get(bbox, F.lit(2)).alias("maxx"), F.greatest(F.get(bbox, F.lit(1)), F.get(bbox, F.lit(3))).alias("maxy"),
    )).when(bbox.isNotNull(), fault("bbox needs four numbers: minx, miny, maxx, maxy", F.to_json(bbox), box_type))
    parsed = searches.select(
        "search_id", column("collections", "array<string>").alias("q_collections"), column("ids", "array<string>").alias("q_ids"),
        F.when(text != "", text).alias("q_datetime"), box.alias("q_box"), wkt.alias("q_wkt"), column("max_items", "bigint").alias("q_page"),
    )
    parsed = parsed.withColumns({
        "q_box_shape": F.when(F.col("q_box").isNotNull(), shape_of_wkt(envelope_wkt(F.col("q_box")))),
        "q_wkt_shape": F.when(F.col("q_wkt").isNotNull(), shape_of_wkt(F.col("q_wkt"))),
    })
    # an end that is given must be read; an open one is '' or '..'
    ends = F.split("q_datetime", "/")
    good = (F.size(ends) <= 2) & ~F.exists(ends, lambda e: ~e.isin("", "..") & instant(e).isNull()) & ((F.size(ends) == 2) | ~F.get(ends, F.lit(0)).isin("", ".."))
    span = F.when(good, datetime_range(F.col("q_datetime"))).otherwise(fault("datetime is neither an instant nor an interval", F.col("q_datetime"), "struct<lo:timestamp,hi:timestamp>"))
    shape_type = parsed.schema["q_wkt_shape"].dataType.simpleString()
    parsed = parsed.withColumns({
        "q_wkt_shape": F.when(F.col("q_wkt").isNotNull() & geojson_of_wkt(F.col("q_wkt")).isNull(), fault("not a WKT geometry", F.col("q_wkt"), shape_type)).otherwise(F.col("q_wkt_shape")),
        "q_range": F.when(F.col("q_datetime").isNotNull(), span),
    })
    segments = F.col("q_wkt_shape.segments")
    parsed = parsed.withColumn("q_extent", F.when(F.size(segments) > 0, extent_of(segments)))
    return parsed.withColumn("q_eff", _effective(F.coalesce("q_box", "q_extent")))


def _cheap_tests(given_by: dict[str, int], named: bool) -> list[Column]:
    """The test of an item against a search without footprints: of the criteria that some search gives, of collections where the two have not met on them (``named``)."""

    def given(criterion, test):
        return criterion.isNull() | F.coalesce(test, F.lit(False))

    def listed(name, value):
        return F.coalesce(F.size(name) <= 0, F.lit(True)) | F.array_contains(name, value)

    box = F.col("bbox")
    tests = {
        "boxes": given(F.col("q_box"), bbox_overlaps(box, F.col("q_box"))), "wkts": F.col("q_wkt").isNull() | F.coalesce(bbox_overlaps(box, F.col("q_extent")), F.lit(False)),
        "ranges": given(F.col("q_range"), _in_range(F.col("i_first"), F.col("i_last"), F.col("q_range"))),
    }
    return [test for criterion, test in tests.items() if given_by[criterion]] + ([listed("q_collections", F.col("collection"))] if named else [])


def _with_shape(items: DataFrame) -> DataFrame:
    """Items with the shape of their footprint, worked out once for each: ``i_shape``, its extent ``i_extent`` and whether it fills that, ``i_fills``."""
    rows = once(items, shape_of_wkt(F.col("geometry")), "i_shape")
    rows = once(rows, F.when(F.col("i_shape").isNotNull(), F.struct(extent_of(F.col("i_shape.segments")).alias("e"), fills_extent(F.col("i_shape")).alias("f"))), "_i")
    return rows.select("*", F.col("_i.e").alias("i_extent"), F.col("_i.f").alias("i_fills")).drop("_i")


def _footprints_meet() -> list[Column]:
    """The tests of an item's shape against the shapes of a search. Against a box the extents say it, but for footprints that reach across its border without being boxes."""
    e, q = F.col("i_extent"), F.col("q_box")
    within = (e["minx"] >= q["minx"]) & (e["maxx"] <= q["maxx"]) & (e["miny"] >= q["miny"]) & (e["maxy"] <= q["maxy"])
    apart = (e["minx"] > q["maxx"]) | (e["maxx"] < q["minx"]) | (e["miny"] > q["maxy"]) | (e["maxy"] < q["miny"])
    plain = F.col("q_plain")
    box = F.when(plain & within, True).when(plain & apart, False).when(plain & F.col("i_fills"), True).otherwise(geom_intersects(F.col("i_shape"), F.col("q_box_shape")))
    wkt = geom_intersects(F.col("i_shape"), F.col("q_wkt_shape"))
    return [F.col("geometry").isNull() | F.col(shape).isNull() | test for shape, test in (("q_box_shape", box), ("q_wkt_shape", wkt))]


def _meet_in_cells(spread: DataFrame, q: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of items and searches that meet in a grid cell (and agree in the other keys), each once."""
    pairs = spread.join(q, ["_level", "_cx", "_cy", *keys])
    # the cell of the greater corner is the greater of the corners' cells
    first = (F.col("_cx") == F.greatest("i_fx", "q_fx")) & (F.col("_cy") == F.greatest("i_fy", "q_fy"))
    return pairs.where((F.col("_level") == F.greatest("i_level", "q_level")) & first)


def _as_nodes(rows: DataFrame) -> DataFrame:
    """Rows of cells as nodes that are not split yet; items with how often a cell of their level may be halved for them."""
    if "i_eff" in rows.columns:
        box = F.col("i_eff")
        rows = rows.withColumn("i_deep", deepest_node(F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"]), _size_of(F.col("_level"))))
    return rows.withColumns({"_depth": F.lit(0), "_nx": F.col("_cx").cast("bigint"), "_ny": F.col("_cy").cast("bigint")}).drop("_cx", "_cy")


def search_batch(items: DataFrame, searches: DataFrame, crowded: int | None = None) -> DataFrame:
    """Every search against every item: (search_id, item columns...), one row per match.

    A search goes the way of its most telling criterion. Ids are joined on the id. A box (or shape) is joined on grid cells, a time without a box, or with one that
    spans a large part of the globe, on buckets of time; both also on the collection where the search names any. An extent lives on the level
    whose cells or buckets are as large as itself, so it touches few there and on each coarser level; a pair meets on the coarser of
    its two levels, in the one cell or bucket in which the common part begins, so no pair is found twice and nothing needs to be made distinct.

    Searches are a written table, so Spark knows what it may broadcast. Where they are too many for that, cells that hold more than ``crowded``
    items are split, as often as their items are small enough for; a number given asks for it at any number of searches. It costs one more read of the
    items' boxes. Long buckets of time are dealt into parts. The searches' shapes stay behind and meet only the pairs that passed all other tests; an item's shape
    is worked out once, before the item meets searches, and only where a search has a shape.

    With a column ``max_items`` the result has ``page_no``: a search's matches in order of id, so many to a page, for searches with a page
    size above 0 and another criterion, else NULL. A datetime, box or geometry that cannot be read raises and names its search.
    """
    work = Workspace(items.sparkSession)
    has_ids, has_collections = F.coalesce(F.size("q_ids") > 0, F.lit(False)), F.coalesce(F.size("q_collections") > 0, F.lit(False))
    by_time = F.col("q_range").isNotNull() & (F.col("q_level") >= WIDE)
    way = F.when(has_ids, "ids").otherwise(F.concat(F.when(by_time, "times").otherwise("cells"), F.when(has_collections, "_named").otherwise("")))
    criterion = has_ids | has_collections | F.col("q_datetime").isNotNull() | F.col("q_box").isNotNull() | F.col("q_wkt").isNotNull()
    table = _search_table(searches).withColumns({"q_level": _level(F.col("q_eff")), "q_span": F.when(F.col("q_range").isNotNull(), span_of(F.col("q_range")))})
    table = table.withColumns({"q_tlevel": time_level(F.col("q_span.first"), F.col("q_span.last")), "q_way": way, "q_no": F.monotonically_increasing_id()})
    # a box that is one rectangle, as nearly all are
    plain = F.coalesce((F.col("q_box.minx") <= F.col("q_box.maxx")) & fills_extent(F.col("q_box_shape")), F.lit(False))
    table = table.withColumns({"q_page": F.when((F.col("q_page") > 0) & criterion, F.col("q_page")), "q_plain": plain})
    n_levels = len(CELL_SIZES)
    table, counts = work.materialize(
        table, "searches", pages=F.count("q_page"), shaped=F.count_if(F.col("q_box_shape").isNotNull() | F.col("q_wkt_shape").isNotNull()),
        boxes=F.count("q_box"), wkts=F.count("q_wkt"), ranges=F.count("q_range"), **{f"way_{w}": F.count_if(F.col("q_way") == w) for w in ("ids", "cells", "cells_named", "times", "times_named")},
        **{f"level_{i}": F.count_if((F.col("q_level") == i) & F.col("q_way").startswith("cells")) for i in range(n_levels)},
        **{f"tlevel_{i}": F.count_if((F.col("q_tlevel") == i) & F.col("q_way").startswith("times")) for i in range(len(TIME_SIZES))},
    )
    q = table.select(
        "q_no", "search_id", "q_page", "q_way", "q_ids", "q_collections", "q_box", "q_plain", "q_wkt", "q_extent", "q_range", "q_eff", "q_level", "q_span", "q_tlevel",
    ).withColumn("q_wkt", F.when(F.col("q_wkt").isNotNull(), ""))
    # what the test needs of an item is made ready once, before the item meets searches
    first, last = _item_times(items.columns)
    known = items.withColumns({"i_first": first, "i_last": last})
    carried = ["i_shape", "i_extent", "i_fills"] if counts["shaped"] else []
    if counts["shaped"]:
        known = _with_shape(known)

    def by_name(route: str):
        """Searches of a route with the key ``_who``, once for each collection they name, and the keys of an item: so items are read once for searches with and without."""
        named = q.withColumn("_who", F.explode(F.transform(F.array_distinct("q_collections"), lambda c: F.concat(F.lit("="), c)))).where(F.col("q_way") == f"{route}_named")
        any_ = q.where(F.col("q_way") == route).withColumn("_who", F.lit(""))
        both = [(any_, F.lit(""))] * bool(counts[f"way_{route}"]) + [(named, F.concat(F.lit("="), F.col("collection")))] * bool(counts[f"way_{route}_named"])
        return reduce(DataFrame.unionByName, [rows for rows, _ in both]), F.array(*[key for _, key in both])

    ways = []
    if counts["way_ids"] or not counts["n_rows"]:
        wanted = q.where("q_way = 'ids'").withColumn("id", F.explode(F.array_distinct("q_ids")))
        ways.append((known.join(wanted, "id"), True))
    n_cells = counts["way_cells"] + counts["way_cells_named"]
    if n_cells:
        # An item meets searches of its own grid or a finer one on its own grid, coarser ones on theirs.
        used = F.array(*[F.lit(i) for i in range(n_levels) if counts[f"level_{i}"]])

        def spread(rows: DataFrame) -> DataFrame:
            placed = rows.withColumn("i_eff", _effective(F.col("bbox")))
            placed = placed.withColumn("i_level", _level(F.col("i_eff")))
            return _with_cells(placed, "i", F.array_union(F.array("i_level"), F.filter(used, lambda l: l > F.col("i_level"))))

        nodes = None
        if crowded is not None or n_cells > MANY_SEARCHES:
            narrow = _as_nodes(spread(items.select("bbox"))).select("_level", "_depth", "_nx", "_ny", "i_eff", "i_deep")
            nodes = crowded_nodes(narrow, "i_eff", "i_deep", _size_of, crowded or CROWDED, work)
        some, who = by_name("cells")
        spreaded = spread(known.withColumn("_who", F.explode(who)))
        cells = _with_cells(some, "q", F.sequence(F.col("q_level"), F.lit(n_levels - 1)))
        if nodes is not None:
            spreaded = items_in_nodes(_as_nodes(spreaded), nodes, "i_eff", "i_deep", _size_of)
            # a search meets many nodes, and the table of searches is a small file
            tasks = 4 * items.sparkSession.sparkContext.defaultParallelism
            cells = searches_in_nodes(_as_nodes(cells.repartition(tasks, "q_no")), nodes, "q_eff", _size_of)
            ways.append((meet_in_nodes(spreaded, cells, "i", "q", _size_of, ["_who"]), False))
        else:
            ways.append((_meet_in_cells(spreaded, cells, ["_who"]), False))
    used_times = [i for i in range(len(TIME_SIZES)) if counts[f"tlevel_{i}"]]
    if used_times:
        some, who = by_name("times")
        timed = known.where(F.col("i_first").isNotNull()).withColumn("_who", F.explode(who))
        timed = timed.withColumn("i_span", span_of(F.struct(F.col("i_first").alias("lo"), F.col("i_last").alias("hi"))))
        timed = timed.withColumn("i_tlevel", time_level(F.col("i_span.first"), F.col("i_span.last")))
        timed = items_by_time(timed, "i_span", "i_tlevel", used_times, F.xxhash64("id", "i_first"))
        ways.append((meet_in_time(timed, searches_by_time(some, "q_span", "q_tlevel"), "i_span", "q_span", ["_who"]), False))
    found = []
    for pairs, named in ways:
        for test in _cheap_tests(counts, named):
            pairs = pairs.where(test)
        found.append(pairs.select("q_no", "search_id", "q_page", "q_box", "q_plain", *carried, *[F.col(f"`{c}`") for c in items.columns]))
    pairs = reduce(DataFrame.unionByName, found)
    if counts["shaped"]:
        pairs = pairs.join(table.select("q_no", "q_box_shape", "q_wkt_shape"), "q_no")
        for test in _footprints_meet():
            pairs = pairs.where(test)
    columns = [F.col(f"`{c}`") for c in items.columns]
    if "max_items" not in searches.columns:
        return pairs.select("search_id", *columns)
    if not counts["pages"]:
        return pairs.select("search_id", *columns, F.lit(None).cast("bigint").alias("page_no"))
    numbered = number_rows(pairs.select("q_no", "search_id", "q_page", *columns), ["q_no", "id"], "_row_no")
    starts = numbered.groupBy("q_no").agg(F.min("_row_no").alias("_first"))
    page = F.floor((F.col("_row_no") - F.col("_first")) / F.col("q_page")).cast("bigint")
    return numbered.join(starts, "q_no").select("search_id", *columns, page.alias("page_no"))
