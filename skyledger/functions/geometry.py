"""Geometry as column work: GeoJSON and WKT text, envelopes, overlap and intersection. No Python runs per row.

Both directions rewrite text instead of building objects. Geometry collections of any depth are rewritten from the inside out,
one nesting level per step of ``aggregate``. All quantified groups in the patterns are possessive, so long geometries do not
deepen the matcher's stack.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import let, once

# GeoJSON type names and their WKT keywords.
KEYWORDS = {
    "Point": "POINT",
    "LineString": "LINESTRING",
    "Polygon": "POLYGON",
    "MultiPoint": "MULTIPOINT",
    "MultiLineString": "MULTILINESTRING",
    "MultiPolygon": "MULTIPOLYGON",
}
# What coordinates of each type look like once vertices are "v", vertex lists "s" and lists of those "p".
OUTLINES = {
    "Point": ["v"],
    "LineString": ["s"],
    "Polygon": ["p"],
    "MultiPoint": ["s"],
    "MultiLineString": ["p"],
    "MultiPolygon": ["[p]"],
}

_NUM = r"[-+]?(?:\d++\.?+\d*+|\.\d++)(?:[eE][-+]?+\d++)?+"


def _replace_each(text: Column, pattern: str, convert: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``convert(match)``."""

    def rebuild(t):
        matches = F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(0))
        gaps = F.split(t, pattern, -1)
        return F.array_join(F.zip_with(gaps, F.transform(matches, convert), lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")

    return let(text, rebuild)


def _outline(coords: Column, vertex: str) -> Column:
    """Shape of a coordinates text without its numbers, see OUTLINES."""
    s = F.regexp_replace(coords, r"\s+", "")
    s = F.regexp_replace(s, vertex, "v")
    s = F.regexp_replace(F.regexp_replace(s, r"v,(?=v)", ""), r"\[v\]", "s")
    s = F.regexp_replace(F.regexp_replace(s, r"s,(?=s)", ""), r"\[s\]", "p")
    return F.regexp_replace(s, r"p,(?=p)", "")


def _matches_outline(kind: Column, outline: Column, allow_empty_members: bool) -> Column:
    # [] is an empty geometry; inside a multi geometry WKT also knows empty members.
    if allow_empty_members:
        outline = F.regexp_replace(outline, r"(?<=[\[,])(?:\[\]|null),|,(?:\[\]|null)(?=[\],])", "")
        outline = F.regexp_replace(outline, r"^\[(?:\[\]|null)\]$", "[]")
        outline = F.regexp_replace(F.regexp_replace(outline, r"^\[v(?:,v)*+\]$", "s"), r"^\[s(?:,s)*+\]$", "p")
        outline = F.regexp_replace(outline, r"^\[p(?:,p)*+\]$", "[p]")
    # fixed words without regard to order: kind, a blank, outline
    valid = [f"{name} {o}" for name, outlines in OUTLINES.items() for o in [*outlines, "[]"]]
    return F.coalesce(F.concat(kind, F.lit(" "), outline).isin(valid), F.lit(False))


def _lookup(key: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


# -- GeoJSON -> WKT ----------------------------------------------------------------------------------------------------


def _plain_number(text: Column) -> Column:
    """Number text as a geometry prints it: 1.0 -> 1, 2.50 -> 2.5."""
    return F.regexp_replace(F.regexp_replace(text, r"\.0++(?![\d])", ""), r"(\.\d*?[1-9])0++(?![\d])", "$1")


def _short_number(text: Column, digits: int) -> Column:
    """Number text with ``digits`` significant digits; very small and very large ones in exponent form."""

    def write(x, exponent, mantissa):
        sign = F.when(x < 0, "-").otherwise("")
        power = F.abs(exponent).cast("string")
        power = F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power)
        scientific = F.concat(sign, _plain_number(mantissa.cast("string")), F.when(exponent < 0, "e-").otherwise("e+"), power)
        fixed = F.lit(None).cast("string")
        for e in range(-4, digits):
            decimals = F.format_string(f"%.{digits - 1 - e}f", F.abs(x))
            fixed = F.when(exponent == e, F.concat(sign, _trim_zeros(decimals))).otherwise(fixed)
        return F.coalesce(fixed, scientific)

    def scale(x):
        exponent = F.floor(F.log10(F.abs(x))).cast("int")
        rough = F.struct(exponent.alias("e"), F.round(F.abs(x) / F.pow(F.lit(10.0), exponent), digits - 1).alias("m"))

        def carry(r):
            over = r["m"] >= 10
            return let(
                F.struct(F.when(over, r["e"] + 1).otherwise(r["e"]).alias("e"), F.when(over, r["m"] / 10).otherwise(r["m"]).alias("m")),
                lambda c: write(x, c["e"], c["m"]),
            )

        return F.when(x == 0, "0").otherwise(let(rough, carry))

    return let(text.cast("double"), scale)


def _trim_zeros(fixed: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(fixed, r"(\.\d*?)0++$", "$1"), r"\.$", "")


# Numbers as JSON and WKT both know them, and areas as most texts spell them: two numbers to a vertex, and blanks in WKT only where it writes them itself.
_PLAIN_NUM = r"-?+(?:0|[1-9]\d*+)(?:\.\d++)?+(?:[eE][-+]?+\d++)?+"


def _list_of(part: str, opening: str, comma: str, closing: str) -> str:
    return rf"{opening}{part}(?:{comma}{part})*+{closing}"


_PLAIN_RINGS = _list_of(_list_of(rf"\[{_PLAIN_NUM},{_PLAIN_NUM}\]", r"\[", ",", r"\]"), r"\[", ",", r"\]")


def _area_wkt(kind: Column, coords: Column) -> Column:
    """WKT of a polygon or several whose coordinates are spelt plainly: one test, and brackets exchanged as plain text. NULL for anything else."""
    text = coords
    for old, new in (("]]],[[[", "))|(("), ("]],[[", ")|("), ("],[", "|"), ("[[[[", "((("), ("[[[", "(("), ("]]]]", ")))"), ("]]]", "))"), (",", " "), ("|", ", ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    one, many = coords.rlike(rf"\A{_PLAIN_RINGS}\z"), coords.rlike(rf"\A{_list_of(_PLAIN_RINGS, chr(92) + '[', ',', chr(92) + ']')}\z")
    return F.when((kind == "Polygon") & one, F.concat(F.lit("POLYGON "), _plain_number(text))).when((kind == "MultiPolygon") & many, F.concat(F.lit("MULTIPOLYGON "), _plain_number(text)))


def _simple_wkt(kind: Column, coords: Column, digits: int | None) -> Column:
    """WKT of a geometry without members of its own, from its type and coordinates text; NULL when it is not valid."""
    return _any_wkt(kind, coords, digits) if digits else F.coalesce(_area_wkt(kind, coords), _any_wkt(kind, coords, digits))


def _any_wkt(kind: Column, coords: Column, digits: int | None) -> Column:
    vertex = rf"\[({_NUM}),({_NUM})(?:,[^\[\]]*+)?+\]"

    def body(g):
        flat = F.translate(g["marked"], "<>", "")
        pairs = (
            F.when(g["kind"] == "Point", F.concat(F.lit("["), flat, F.lit("]")))
            .when(g["kind"] == "MultiPoint", F.translate(g["marked"], "<>", "[]"))
            .otherwise(flat)
        )
        text = F.replace(F.translate(pairs, "[]", "()"), F.lit(","), F.lit(", "))
        return _replace_each(text, _NUM, lambda n: _short_number(n, digits)) if digits else _plain_number(text)

    def convert(g):
        ok = _matches_outline(g["kind"], _outline(g["marked"], r"<[^<>]*+>"), allow_empty_members=False)
        text = F.when(g["marked"] == "[]", F.lit("EMPTY")).otherwise(body(g))
        return F.when(ok, F.concat(_lookup(g["kind"], KEYWORDS), F.lit(" "), text))

    # vertices in angle brackets, x and y only
    marked = F.regexp_replace(F.regexp_replace(coords, r"\s++", ""), vertex, "<$1 $2>")
    return let(F.struct(kind.alias("kind"), marked.alias("marked")), convert)


def _collection_wkt(members: Column) -> Column:
    """WKT of a GeometryCollection whose members are already WKT strings; NULL when a member is not."""

    def join(members):
        valid = ~F.exists(members, lambda m: m.isNull() | ~m.rlike(r"^[A-Z]+ "))
        text = F.when(F.size(members) == 0, F.lit("GEOMETRYCOLLECTION EMPTY")).otherwise(
            F.concat(F.lit("GEOMETRYCOLLECTION ("), F.array_join(members, ", "), F.lit(")"))
        )
        return F.when(valid, text)

    return let(F.from_json(members, "array<string>"), join)


def _wkt_of_parts(g: Column, digits: int | None) -> Column:
    return F.when(g["type"] == "GeometryCollection", _collection_wkt(g["geometries"])).otherwise(
        _simple_wkt(g["type"], g["coordinates"], digits)
    )


def _nested_wkt(members: Column, digits: int | None) -> Column:
    """WKT of a GeometryCollection from the text of its ``geometries``, rewritten from the innermost objects outwards."""
    innermost = r"\{[^{}]*+\}"

    def inside_out(text, _):
        def convert(obj):
            wkt = let(F.from_json(obj, GEOJSON_PARTS), lambda g: _wkt_of_parts(g, digits))
            return F.coalesce(F.concat(F.lit('"'), wkt, F.lit('"')), F.lit("null"))

        return _replace_each(text, innermost, convert)

    def rewrite(text):
        levels = F.sequence(F.lit(0), F.size(F.regexp_extract_all(text, F.lit(r"(\{)"), F.lit(0))))
        return _collection_wkt(F.aggregate(levels, text, inside_out))

    return let(members, rewrite)


# What a GeoJSON geometry is read as, in one pass.
GEOJSON_PARTS = "type STRING, coordinates STRING, geometries STRING"


def wkt_of_parts(parts: Column, digits: int | None = None) -> Column:
    """WKT text of a geometry read as GEOJSON_PARTS, x and y only; NULL when it is invalid."""
    nested = F.when(parts["geometries"].startswith("["), _nested_wkt(parts["geometries"], digits))
    simple = _simple_wkt(parts["type"], parts["coordinates"], digits)
    return F.when(parts["type"] == "GeometryCollection", nested).otherwise(simple)


def wkt_of_geojson(geometry: Column, digits: int | None = None) -> Column:
    """WKT text of a GeoJSON geometry, x and y only; NULL when the geometry is invalid."""
    return let(F.from_json(geometry, GEOJSON_PARTS), lambda g: wkt_of_parts(g, digits))


def geojson_to_wkt(df, col: str, digits: int | None = None, strict: bool = True):
    """Replace the GeoJSON column ``col`` by WKT. An invalid geometry raises, or gives NULL when ``strict`` is off."""
    return _converted(df, col, wkt_of_geojson(F.col(col), digits), "not a GeoJSON geometry: " if strict else None)


def _converted(df, col: str, value: Column, complaint: str | None):
    done = once(df, value, "_converted")
    result = F.col("_converted")
    if complaint:
        given = F.col(col).isNotNull()
        result = F.when(result.isNull() & given, F.raise_error(F.concat(F.lit(complaint), F.col(col))).cast("string")).otherwise(result)
    return done.select(*[result.alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])


# -- WKT -> GeoJSON ----------------------------------------------------------------------------------------------------

_P1 = r"\([^()]*+\)"
_P2 = rf"\((?:[^()]++|{_P1})*+\)"
_P3 = rf"\((?:[^()]++|{_P2})*+\)"
_SIMPLE = rf"(?<![A-Z])(?:MULTI)?+(?:POINT|LINESTRING|POLYGON)[ZM]*+(?:~|{_P3})"


def _canonical_wkt(wkt: Column) -> Column:
    """Upper case, no SRID, no loose spaces, ``~`` for EMPTY, ``e`` only in exponents: POINTZ(1 2 3)."""
    s = F.trim(F.regexp_replace(F.upper(wkt), r"\s+", " "))
    s = F.regexp_replace(s, rf"SRID ?= ?{_NUM} ?; ?", "")
    s = F.regexp_replace(s, r"EMPTY", "~")
    s = F.regexp_replace(s, r"(?<=[\d.])E(?=[-+\d])", "e")
    s = F.regexp_replace(s, r" ?([(),~]) ?", "$1")
    return F.regexp_replace(s, r"(?<=[A-Z]) (?=[A-Z(~])", "")


def _simple_member(geometry: Column) -> Column:
    """Struct (kind, coords): GeoJSON type and coordinates text of one canonical WKT geometry, coords NULL when malformed."""
    kinds = {word: name for name, word in KEYWORDS.items()}

    def convert(g):
        inner = F.substr(g["body"], F.lit(2), F.length(g["body"]) - 2)
        body = (
            F.when(g["body"] == "~", F.lit("[]"))
            .when(g["kind"] == "MultiPoint", F.concat(F.lit("("), F.replace(F.translate(inner, "()", ""), F.lit("~"), F.lit("null")), F.lit(")")))
            .when(g["kind"] == "Point", inner)
            .otherwise(F.replace(g["body"], F.lit("~"), F.lit("[]")))
        )
        body = F.regexp_replace(F.replace(body, F.lit(","), F.lit(";")), rf"({_NUM}(?: {_NUM})*+)", "[$1]")
        body = F.replace(F.replace(body, F.lit(" "), F.lit(", ")), F.lit(";"), F.lit(", "))
        return let(F.translate(body, "()", "[]"), lambda coords: check(g, coords))

    def check(g, coords):
        outline = F.lit(None).cast("string")
        for extra in range(3):
            vertex = rf"\[{_NUM}(?:,{_NUM}){{{1 + extra}}}+\]"
            outline = F.when(F.length(g["tag"]) == extra, _outline(coords, vertex)).otherwise(outline)
        ok = _matches_outline(g["kind"], outline, allow_empty_members=True)
        return F.struct(g["kind"].alias("kind"), F.when(ok, coords).alias("coords"))

    word = F.regexp_extract(geometry, r"^((?:MULTI)?+(?:POINT|LINESTRING|POLYGON))", 1)
    parts = F.struct(
        _lookup(word, kinds).alias("kind"),
        F.regexp_extract(geometry, r"^[A-Z]+?(Z?M?)(?=[(~])", 1).alias("tag"),
        F.regexp_extract(geometry, r"^[A-Z]++(.*)$", 1).alias("body"),
    )
    return let(parts, convert)


def geojson_of_wkt(wkt: Column) -> Column:
    """GeoJSON text of a WKT geometry, numbers with ten decimals; NULL when the text is no geometry."""

    def simple(geometry):
        def write(m):
            coords = _replace_each(m["coords"], _NUM, lambda n: F.format_string("%.10f", n.cast("double")))
            text = F.concat(F.lit('{"type": "'), m["kind"], F.lit('", "coordinates": '), coords, F.lit("}"))
            return F.coalesce(text, F.lit("!"))

        return let(_simple_member(geometry), write)

    def wrap(text, _):
        text = F.regexp_replace(text, r"GEOMETRYCOLLECTION[ZM]*+~", '{"type": "GeometryCollection", "geometries": []}')
        members = r"GEOMETRYCOLLECTION[ZM]*+\(([^()]++)\)"
        return _replace_each(
            text, members,
            lambda m: F.concat(
                F.lit('{"type": "GeometryCollection", "geometries": ['),
                F.regexp_replace(F.regexp_extract(m, members, 1), r"\},\{", "}, {"), F.lit("]}"),
            ),
        )

    def convert(s):
        levels = F.sequence(F.lit(0), F.size(F.regexp_extract_all(s, F.lit("(GEOMETRYCOLLECTION)"), F.lit(0))))
        # one dimension tag for the whole text
        tags = F.regexp_extract_all(s, F.lit(r"(?:POINT|LINESTRING|POLYGON|GEOMETRYCOLLECTION)([ZM]*+)"), F.lit(1))
        text = F.aggregate(levels, _replace_each(s, _SIMPLE, simple), wrap)
        return F.when(F.size(F.array_distinct(tags)) == 1, let(text, accept))

    def accept(text):
        clean = text.rlike(r'^\{"type"') & text.endswith("}") & ~text.rlike(r"[()!~]|[A-Z]{2}|\}\s*+\{")
        return F.when(clean & F.try_parse_json(text).isNotNull(), text)

    return let(_canonical_wkt(wkt), convert)


def wkt_to_geojson(df, col: str, strict: bool = True):
    """Replace the WKT column ``col`` by GeoJSON. Text that is no geometry raises, or gives NULL when ``strict`` is off."""
    return _converted(df, col, geojson_of_wkt(F.col(col)), "not a WKT geometry: " if strict else None)


# -- envelopes ---------------------------------------------------------------------------------------------------------


def make_envelope(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Struct (minx, miny, maxx, maxy) with the corners put in order."""
    return F.struct(
        F.least(minx, maxx).alias("minx"), F.least(miny, maxy).alias("miny"),
        F.greatest(minx, maxx).alias("maxx"), F.greatest(miny, maxy).alias("maxy"),
    )


def envelope_wkt(box: Column) -> Column:
    """Rectangle of a box as WKT; a box with minx > maxx crosses the antimeridian and gives two rectangles."""

    def ring(x0, x1):
        def at(x, y):
            return F.concat(_plain_number(x.cast("string")), F.lit(" "), _plain_number(y.cast("string")))

        y0, y1 = box["miny"], box["maxy"]
        corners = [at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0)]
        return F.concat(F.lit("(("), F.concat_ws(", ", *corners), F.lit("))"))

    whole = F.concat(F.lit("POLYGON "), ring(box["minx"], box["maxx"]))
    east, west = ring(box["minx"], F.lit(180.0)), ring(F.lit(-180.0), box["maxx"])
    halves = F.concat(F.lit("MULTIPOLYGON ("), east, F.lit(", "), west, F.lit(")"))
    return F.when(box["minx"] > box["maxx"], halves).otherwise(whole)


def bbox_overlaps(a: Column, b: Column) -> Column:
    """Inclusive overlap of two boxes. A box with minx > maxx crosses the antimeridian."""
    plain = (a["minx"] <= b["maxx"]) & (a["maxx"] >= b["minx"])
    either = (a["minx"] <= b["maxx"]) | (a["maxx"] >= b["minx"])
    a_wraps, b_wraps = a["minx"] > a["maxx"], b["minx"] > b["maxx"]
    along_x = (~a_wraps & ~b_wraps & plain) | (a_wraps & b_wraps) | ((a_wraps | b_wraps) & either)
    return (a["miny"] <= b["maxy"]) & (a["maxy"] >= b["miny"]) & along_x


# -- intersection ------------------------------------------------------------------------------------------------------

# A shape holds what the test needs: all segments (a lone point is a segment of length zero), one vertex per connected part,
# and the ring edges of each polygon.
SEGMENT = "struct<x1:double,y1:double,x2:double,y2:double>"
SHAPE = f"struct<segments:array<{SEGMENT}>,vertices:array<struct<x:double,y:double>>,polygons:array<array<{SEGMENT}>>>"


def _edges(seq: Column) -> Column:
    def edge(p, q):
        return F.struct(
            F.get(p, F.lit(0)).alias("x1"), F.get(p, F.lit(1)).alias("y1"),
            F.get(q, F.lit(0)).alias("x2"), F.get(q, F.lit(1)).alias("y2"),
        )

    pairs = F.zip_with(F.slice(seq, F.lit(1), F.size(seq) - 1), F.slice(seq, F.lit(2), F.size(seq) - 1), edge)
    lone = F.transform(seq, lambda p: edge(p, p))
    return F.when(F.size(seq) > 1, pairs).otherwise(lone)


def _shape_of_members(members: Column) -> Column:
    """Shape of ``array<struct<kind, coords>>``, coords being JSON text."""

    def collect(depth: int, kinds: dict[str, int]) -> Column:
        """Coordinates of the members of these kinds, lifted to one nesting depth and put in one array."""
        ddl = "double"
        for _ in range(depth):
            ddl = f"array<{ddl}>"
        chosen = F.filter(members, lambda m: m["kind"].isin(*kinds))

        def lift(m):
            text = m["coords"]
            for kind, brackets in kinds.items():
                text = F.when(m["kind"] == kind, F.concat(F.lit("[" * brackets), m["coords"], F.lit("]" * brackets))).otherwise(text)
            return F.from_json(text, ddl)

        return F.flatten(F.transform(chosen, lift))

    # lone points, lines and polygons, each evaluated once
    points = F.filter(collect(2, {"Point": 1, "MultiPoint": 0}), lambda p: F.size(p) >= 2)
    lines = F.filter(collect(3, {"LineString": 1, "MultiLineString": 0}), lambda s: F.size(s) > 0)
    polygons = F.filter(collect(4, {"Polygon": 1, "MultiPolygon": 0}), lambda p: F.size(p) > 0)

    def vertex(p):
        return F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))

    def build(g):
        point_edges = F.flatten(F.transform(g["points"], lambda p: _edges(F.array(p))))
        line_edges = F.flatten(F.transform(g["lines"], _edges))
        vertices = F.concat(
            F.transform(g["points"], vertex), F.transform(g["lines"], lambda s: vertex(F.get(s, F.lit(0)))),
            F.transform(g["polygons"], lambda p: vertex(F.get(F.get(p, F.lit(0)), F.lit(0)))),
        )
        polygon_edges = F.transform(g["polygons"], lambda p: F.flatten(F.transform(p, _edges)))
        return let(
            polygon_edges,
            lambda e: F.struct(
                F.concat(point_edges, line_edges, F.flatten(e)).alias("segments"), vertices.alias("vertices"), e.alias("polygons")
            ),
        )

    return let(F.struct(points.alias("points"), lines.alias("lines"), polygons.alias("polygons")), build)


_PLAIN_VERTICES = _list_of(f"{_PLAIN_NUM} {_PLAIN_NUM}", r"\(", ", ", r"\)")
_PLAIN_LISTS = _list_of(_PLAIN_VERTICES, r"\(", ", ", r"\)")
_PLAIN_WKT = rf"\A(?:POINT \({_PLAIN_NUM} {_PLAIN_NUM}\)|LINESTRING {_PLAIN_VERTICES}|(?:POLYGON|MULTILINESTRING) {_PLAIN_LISTS}|MULTIPOLYGON {_list_of(_PLAIN_LISTS, chr(92) + '(', ', ', chr(92) + ')')})\z"


def _plain_members(wkt: Column) -> Column:
    """The members of one geometry spelt as this library writes it. A point counts as several, as its brackets are theirs."""
    kinds = {"POLYGON": "Polygon", "MULTIPOLYGON": "MultiPolygon", "POINT": "MultiPoint", "LINESTRING": "LineString", "MULTILINESTRING": "MultiLineString"}
    kind = F.lit(None).cast("string")
    for word, name in reversed(kinds.items()):
        kind = F.when(wkt.startswith(f"{word} "), name).otherwise(kind)
    body = F.translate(F.substr(wkt, F.instr(wkt, " ") + 1), "()", "[]")
    return F.array(F.struct(kind.alias("kind"), F.regexp_replace(body, r"([^\[\], ]++) ([^\[\], ]++)", "[$1,$2]").alias("coords")))


def shape_of_wkt(wkt: Column) -> Column:
    """Working column for ``geom_intersects``; NULL for text without a geometry."""
    return let(wkt, lambda w: F.when(w.isNotNull(), let(F.when(w.rlike(_PLAIN_WKT), _plain_members(w)).otherwise(_members(w)), _shape_of_members)))


def _members(wkt: Column) -> Column:
    """The simple geometries of any WKT text that aren't empty, as (kind, coords)."""
    parts = F.regexp_extract_all(_canonical_wkt(wkt), F.lit(f"({_SIMPLE})"), F.lit(0))

    def member(geometry):
        def drop_empty(m):
            return F.struct(m["kind"].alias("kind"), F.regexp_replace(m["coords"], r"(?:null|\[\]), |, (?:null|\[\])", "").alias("coords"))

        return let(_simple_member(geometry), drop_empty)

    return F.filter(F.transform(parts, member), lambda m: ~m["coords"].isin("[]", "[null]", "[[]]"))


def _side(x0: Column, y0: Column, x1: Column, y1: Column, x: Column, y: Column) -> Column:
    return F.signum((x1 - x0) * (y - y0) - (y1 - y0) * (x - x0))


def _segments_meet(p: Column, q: Column) -> Column:
    """Boxes overlap and each segment straddles, or touches, the line of the other."""
    boxes = (
        (F.least(p["x1"], p["x2"]) <= F.greatest(q["x1"], q["x2"])) & (F.least(q["x1"], q["x2"]) <= F.greatest(p["x1"], p["x2"]))
        & (F.least(p["y1"], p["y2"]) <= F.greatest(q["y1"], q["y2"])) & (F.least(q["y1"], q["y2"]) <= F.greatest(p["y1"], p["y2"]))
    )
    p_ends = _side(q["x1"], q["y1"], q["x2"], q["y2"], p["x1"], p["y1"]) * _side(q["x1"], q["y1"], q["x2"], q["y2"], p["x2"], p["y2"])
    q_ends = _side(p["x1"], p["y1"], p["x2"], p["y2"], q["x1"], q["y1"]) * _side(p["x1"], p["y1"], p["x2"], p["y2"], q["x2"], q["y2"])
    return boxes & (p_ends <= 0) & (q_ends <= 0)


def _crosses(e: Column, v: Column) -> Column:
    """Whether the ray from a point to the right crosses an edge."""
    spans = (e["y1"] > v["y"]) != (e["y2"] > v["y"])
    at = (e["x2"] - e["x1"]) * F.try_divide(v["y"] - e["y1"], e["y2"] - e["y1"]) + e["x1"]
    return spans & (v["x"] < at)


def _inside(polygons: Column, v: Column) -> Column:
    """Even-odd test against each polygon, holes included. Points on a boundary are met by the segment test."""
    return F.exists(polygons, lambda p: F.size(F.filter(p, lambda e: _crosses(e, v))) % 2 == 1)


def extent_of(segments: Column) -> Column:
    """Struct (minx, miny, maxx, maxy) around segments, its members NULL without any."""

    def bound(pick, either, one, two):
        return pick(F.transform(segments, lambda s: either(s[one], s[two])))

    return F.struct(
        bound(F.array_min, F.least, "x1", "x2").alias("minx"), bound(F.array_min, F.least, "y1", "y2").alias("miny"),
        bound(F.array_max, F.greatest, "x1", "x2").alias("maxx"), bound(F.array_max, F.greatest, "y1", "y2").alias("maxy"),
    )


def fills_extent(shape: Column) -> Column:
    """Whether a shape is one rectangle along the axes, so that its extent says all about it: four different corners, from each to the next, and back."""

    def rectangle(g):
        s, e = g["s"], g["e"]
        along = F.forall(s, lambda p: ((p["x1"] == p["x2"]) != (p["y1"] == p["y2"])) & p["x1"].isin(e["minx"], e["maxx"]) & p["y1"].isin(e["miny"], e["maxy"]))
        corners = F.size(F.array_distinct(F.transform(s, lambda p: F.struct(p["x1"], p["y1"])))) == 4
        first, last = F.get(s, F.lit(0)), F.get(s, F.lit(3))
        return along & corners & (last["x2"] == first["x1"]) & (last["y2"] == first["y1"])

    four = (F.size(shape["segments"]) == 4) & (F.size(shape["polygons"]) == 1) & (F.size(shape["vertices"]) == 1)
    return F.coalesce(four & let(F.struct(shape["segments"].alias("s"), extent_of(shape["segments"]).alias("e")), rectangle), F.lit(False))


def _near(segments: Column, extent: Column) -> Column:
    """The segments whose box meets an extent."""
    return F.filter(segments, lambda s: (
        (F.least(s["x1"], s["x2"]) <= extent["maxx"]) & (F.greatest(s["x1"], s["x2"]) >= extent["minx"])
        & (F.least(s["y1"], s["y2"]) <= extent["maxy"]) & (F.greatest(s["y1"], s["y2"]) >= extent["miny"])
    ))


def geom_intersects(a: Column, b: Column) -> Column:
    """True when two shapes share a point, boundaries included. Shapes whose extents are apart share none; else only segments near the other shape are tested
    against each other. Each shape is worked out once, whatever expression it is."""

    def test(g):
        a, b, ea, eb = g["a"], g["b"], g["ea"], g["eb"]
        near = F.struct(_near(a["segments"], eb).alias("p"), _near(b["segments"], ea).alias("q"))
        met = let(near, lambda n: F.exists(n["p"], lambda p: F.exists(n["q"], lambda q: _segments_meet(p, q))))
        a_in_b = F.exists(a["vertices"], lambda v: _inside(b["polygons"], v))
        b_in_a = F.exists(b["vertices"], lambda v: _inside(a["polygons"], v))
        apart = (ea["minx"] > eb["maxx"]) | (ea["maxx"] < eb["minx"]) | (ea["miny"] > eb["maxy"]) | (ea["maxy"] < eb["miny"])
        return F.when(apart, False).otherwise(met | a_in_b | b_in_a)

    def extents(g):
        return let(F.struct(g["a"].alias("a"), g["b"].alias("b"), extent_of(g["a"]["segments"]).alias("ea"), extent_of(g["b"]["segments"]).alias("eb")), test)

    return let(F.struct(a.alias("a"), b.alias("b")), extents)


def _parsed(spark: SparkSession, wkt: Column) -> tuple[str, dict, tuple[float, float, float, float] | None]:
    """A search geometry parsed once: its shape as JSON text and as objects, and its extent. Raises ValueError for text that is no geometry."""
    given = spark.range(1).select(wkt.alias("wkt"))
    row = given.select("wkt", geojson_of_wkt(F.col("wkt")).isNotNull().alias("ok"), F.to_json(shape_of_wkt(F.col("wkt"))).alias("s")).first()
    if not row["ok"]:
        raise ValueError(f"not a WKT geometry: {row['wkt']}")
    shape = json.loads(row["s"])
    xs = [x for s in shape["segments"] for x in (s["x1"], s["x2"])]
    ys = [y for s in shape["segments"] for y in (s["y1"], s["y2"])]
    return row["s"], shape, ((min(xs), min(ys), max(xs), max(ys)) if xs else None)


def shape_literal(spark: SparkSession, wkt: Column) -> tuple[Column, tuple[float, float, float, float] | None]:
    """A search geometry as a literal shape and its extent. Raises ValueError for text that is no geometry."""
    text, _, extent = _parsed(spark, wkt)
    # one text in the plan, which Spark folds to a value, however many vertices there are
    return F.from_json(F.lit(text), SHAPE), extent


# -- a search geometry of many edges -------------------------------------------------------------------------------------

#: edges from which on a search geometry is cut into bands; edges in a band on average, and entries in all bands for each edge at most
MANY_EDGES, IN_BAND, ENTRIES = 64, 8, 4
BANDS = "struct<bands:array<array<struct<x1:double,y1:double,x2:double,y2:double,polygon:int>>>,parts:array<array<struct<x:double,y:double>>>>"


def _cut_bands(shape: dict, low: float, high: float) -> tuple[float, int, dict]:
    """Height and number of bands of equal height, and the edges and first vertices of parts in each. An edge is in all bands that it touches; where long ones would
    come too often, bands are fewer."""
    edges = [(e, k) for k, polygon in enumerate(shape["polygons"]) for e in polygon]
    edges += [(e, -1) for e in shape["segments"][: len(shape["segments"]) - len(edges)]]
    n = max(1, len(edges) // IN_BAND) if high > low else 1
    while True:
        height = (high - low) / n if high > low else 1.0

        def band(y: float) -> int:
            return min(max(math.floor((y - low) / height), 0), n - 1)

        spans = [(band(min(e["y1"], e["y2"])), band(max(e["y1"], e["y2"]))) for e, _ in edges]
        if n == 1 or sum(b - a + 1 for a, b in spans) <= ENTRIES * len(edges):
            break
        n //= 2
    bands: list[list] = [[] for _ in range(n)]
    for (first, last), (e, polygon) in zip(spans, edges):
        for k in range(first, last + 1):
            bands[k].append(e | {"polygon": polygon})
    parts: list[list] = [[] for _ in range(n)]
    for v in shape["vertices"]:
        parts[band(v["y"])].append(v)
    return height, n, {"bands": bands, "parts": parts}


def shape_test(spark: SparkSession, wkt: Column) -> tuple[Callable[[Column], Column], tuple[float, float, float, float] | None]:
    """The test of shapes against a search geometry, and its extent. Raises ValueError for text that is no geometry.

    A geometry of many edges is cut into bands once; a vertex of a shape then looks at the edges of its band only, and an edge at those of the bands
    that it touches.
    """
    text, shape, extent = _parsed(spark, wkt)
    if len(shape["segments"]) < MANY_EDGES:
        return lambda given: geom_intersects(given, F.from_json(F.lit(text), SHAPE)), extent
    low = extent[1]
    height, n, cut = _cut_bands(shape, low, extent[3])
    literal = F.from_json(F.lit(json.dumps(cut)), BANDS)

    def band(y: Column) -> Column:
        return F.least(F.greatest(F.floor((y - F.lit(low)) / F.lit(height)), F.lit(0)), F.lit(n - 1)).cast("int")

    def between(rows: Column, first: Column, last: Column) -> Column:
        return F.slice(rows, band(first) + 1, band(last) - band(first) + 1)

    def meets(given: Column) -> Column:
        def edge_meets(p: Column) -> Column:
            near = between(literal["bands"], F.least(p["y1"], p["y2"]), F.greatest(p["y1"], p["y2"]))
            return F.exists(near, lambda edges: F.exists(edges, lambda q: _segments_meet(p, q)))

        def vertex_inside(v: Column) -> Column:
            crossed = F.filter(F.get(literal["bands"], band(v["y"])), lambda e: (e["polygon"] >= 0) & _crosses(e, v))
            return let(F.transform(crossed, lambda e: e["polygon"]), lambda ids: F.exists(ids, lambda k: F.size(F.filter(ids, lambda i: i == k)) % 2 == 1))

        def part_inside(polygon: Column) -> Column:
            ys = F.transform(polygon, lambda e: e["y1"])
            near = F.flatten(between(literal["parts"], F.array_min(ys), F.array_max(ys)))
            return F.exists(near, lambda v: F.size(F.filter(polygon, lambda e: _crosses(e, v))) % 2 == 1)

        polygons = F.filter(given["polygons"], lambda p: F.size(p) > 0)
        return F.exists(given["segments"], edge_meets) | F.exists(given["vertices"], vertex_inside) | F.exists(polygons, part_inside)

    return meets, extent


def parse_envelope(bbox) -> tuple[float, float, float, float]:
    """Four numbers of a search box; minx > maxx stays, it crosses the antimeridian."""
    if len(bbox) != 4:
        raise ValueError("bbox needs four numbers: minx, miny, maxx, maxy")
    minx, miny, maxx, maxy = (float(n) for n in bbox)
    return minx, min(miny, maxy), maxx, max(miny, maxy)

