"""Struct types of the item table."""

from pyspark.sql import types as T

BBOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("minx", "miny", "maxx", "maxy")])
LINK = T.StructType([T.StructField(n, T.StringType()) for n in ("href", "type", "title", "rel")])
ASSET = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("href", "type", "title", "description")]
    + [T.StructField("roles", T.ArrayType(T.StringType()))]
)

# Fixed columns of the item table, in order; property columns follow.
FIXED_COLUMNS = ["catalog", "collection", "id", "geometry", "bbox", "stac_extensions", "links", "assets"]
# Document kinds whose links are followed.
CONTAINER_KINDS = ["Catalog", "Collection", "FeatureCollection"]
# Link relations that lead to children.
CHILD_RELS = ["item", "child", "items"]
