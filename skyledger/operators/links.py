"""Links as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import let, once
from skyledger.functions.json import lenient, member_text, text_of
from skyledger.functions.uri import resolve_href
from skyledger.types import CHILD_RELS, CONTAINER_KINDS


def explode_links(documents: DataFrame) -> DataFrame:
    """One row per usable link: (doc_uri, pos, rel, href, method, merge, headers, body).

    A link that is no object, or whose href or rel is missing or empty, gives no row.
    """
    link = "href VARIANT, rel VARIANT, method VARIANT, merge VARIANT, headers MAP<STRING,VARIANT>, body VARIANT"
    rows = lenient(documents).select("doc_uri", F.posexplode(F.from_json("body", "links ARRAY<STRING>")["links"]).alias("pos", "text"))
    rows = rows.where(F.col("text").startswith("{")).withColumn("l", F.from_json("text", link))
    headers = F.map_filter(F.transform_values("l.headers", lambda _, v: text_of(v)), lambda _, v: v.isNotNull())
    is_body = F.schema_of_variant("l.body").startswith("OBJECT")
    return rows.select(
        "doc_uri", F.col("pos").cast("bigint").alias("pos"),
        text_of(F.col("l.rel")).alias("rel"), text_of(F.col("l.href")).alias("href"),
        F.coalesce(text_of(F.col("l.method")), F.lit("GET")).alias("method"),
        F.when(F.schema_of_variant("l.merge") == "BOOLEAN", F.col("l.merge").cast("boolean")).otherwise(False).alias("merge"),
        headers.alias("headers"),
        F.when(is_body, F.get_json_object("text", "$.body")).alias("body"),
    ).where("href <> '' AND rel <> ''")


def _child_links(doc_uri: Column, links: Column) -> Column:
    """Links to children and next pages: array<struct<pos, rel, dst>>, in document order."""

    def target(v, i):
        def resolve(link):
            wanted = link["rel"].isin(*CHILD_RELS, "next") & (link["href"] != "")
            dst = resolve_href(doc_uri, link["href"]).alias("dst")
            return F.when(wanted, F.struct(i.cast("bigint").alias("pos"), link["rel"].alias("rel"), dst))

        return let(F.struct(member_text(v, "rel").alias("rel"), member_text(v, "href").alias("href")), resolve)

    return F.array_compact(F.transform(links, target))


def container_nodes(documents: DataFrame) -> DataFrame:
    """The documents whose links are followed: (doc_uri, kind, own_id, child_links, item_links, next_uri).

    A narrow table next to the documents. Item links, which are most of all links, are a column of their own, so that the walk
    through catalogs and collections does not read them.
    """
    # Most documents are items: a test of the raw text spares parsing them. A type spelt with escapes passes it too.
    spelt = [F.contains("body", F.lit(t)) for t in ('Catalog"', 'Collection"', "\\u")]
    documents = lenient(documents).where(spelt[0] | spelt[1] | spelt[2])
    head = documents.select("doc_uri", F.from_json("body", "type VARIANT, id VARIANT, links ARRAY<VARIANT>").alias("d"))
    nodes = head.select("doc_uri", text_of(F.col("d.type")).alias("kind"), text_of(F.col("d.id")).alias("own_id"), F.col("d.links").alias("links"))
    nodes = nodes.where(F.col("kind").isin(CONTAINER_KINDS))
    nodes = once(nodes, _child_links(F.col("doc_uri"), F.col("links")), "l")
    # of several next links the last one counts
    next_uri = F.try_element_at(F.filter("l", lambda l: l["rel"] == "next"), F.lit(-1))["dst"]
    return nodes.select(
        "doc_uri", "kind", "own_id", F.filter("l", lambda l: l["rel"].isin("child", "items")).alias("child_links"),
        F.filter("l", lambda l: l["rel"] == "item").alias("item_links"), next_uri.alias("next_uri"),
    )
