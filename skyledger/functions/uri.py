"""Column helpers on document addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.columns import let, no_strings

_PREFIX = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/]*)?/*"


def is_static(uri: Column) -> Column:
    """True for a JSON document; an address with a query string or any other ending is an endpoint."""
    return F.lower(uri).rlike(r"\.(geo)?json$")


def resolve_href(base: Column, href: Column) -> Column:
    """Join a relative ``href`` to the folder of the document it stands in; absolute paths and schemes stay as they are.

    An absolute path on a local file is a local file.
    """

    def join(p):
        plain, tail = p["plain"], p["tail"]
        joined = F.concat(F.regexp_replace(p["path"], r"[^/]*$", ""), plain, tail)
        dotted = plain.rlike(r"(^|/)\.\.?(/|$)")
        return F.when(dotted, F.concat(_fold_dots(p["path"], plain), tail)).otherwise(joined)

    parts = F.struct(
        F.regexp_replace(base, r"[?#].*$", "").alias("path"),
        F.regexp_replace(F.regexp_extract(href, r"^[^?#]*", 0), r"^(\./)+", "").alias("plain"),
        F.regexp_extract(href, r"[?#].*$", 0).alias("tail"),
    )
    local = F.startswith(base, F.lit("file:")) & F.startswith(href, F.lit("/"))
    absolute = F.when(local, F.regexp_replace(href, "^/+", "file:///")).otherwise(href)
    return F.when(href.rlike(r"^([A-Za-z][A-Za-z0-9+.\-]*:|/)"), absolute).otherwise(let(parts, join))


def _fold_dots(path: Column, relative: Column) -> Column:
    """Walk ``relative`` from the folder of ``path``; ``..`` never climbs above the scheme, host or root."""

    def walk(p):
        def step(done, segment):
            at_top = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1)) == "..")
            climbed = (
                F.when(~at_top, F.slice(done, F.lit(1), F.size(done) - 1))
                .when(p["prefix"] == "", F.concat(done, F.array(segment)))
                .otherwise(done)
            )
            return (
                F.when(segment == ".", done)
                .when(segment == "..", climbed)
                .otherwise(F.concat(done, F.array(segment)))
            )

        folder = F.regexp_extract(F.substr(path, F.length(p["prefix"]) + 1), r"^(.*)/[^/]*$", 1)
        start = let(folder, lambda f: F.when(f == "", no_strings()).otherwise(F.split(f, "/")))
        return F.concat(p["prefix"], F.array_join(F.aggregate(F.split(relative, "/"), start, step), "/"))

    return let(F.struct(F.regexp_extract(path, _PREFIX, 0).alias("prefix")), walk)
