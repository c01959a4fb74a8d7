"""Reading a whole catalog as one table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.crawl import Closure, attach, features_of
from skyledger.operators.items import finish_items, pick_columns, pick_fixed, shape_features
from skyledger.operators.schema import infer_schema, property_fields
from skyledger.sources.linked import linked_documents


def read(
    documents: DataFrame, root_uris, schema: T.StructType | None = None, mode: str = "all", strict: bool = True, columns=None,
    wkt_digits: int | None = None, on_missing: str = "fail", on_error: str = "fail", keep=(), fixed=None,
) -> DataFrame:
    """The item table of the catalog whose root document is ``root_uris``.

    Features are parsed before they meet the result of the closure, so the shuffle carries the columns a query asks for and not
    the documents. Without a ``schema`` the property columns are learnt first (``mode`` as in ``infer_schema``). ``columns`` and ``fixed``
    choose columns as in ``items``.
    """
    closure = Closure(documents, root_uris, on_missing=on_missing)
    features = features_of(documents)
    if schema is None:
        fields = features.withColumn("fields", property_fields(F.col("feature")))
        schema = infer_schema(attach(fields, closure.targets, on_error), mode)
    schema = pick_columns(schema, columns)
    geometry = "geometry" in pick_fixed(fixed)
    shaped = attach(shape_features(features, schema, wkt_digits, geometry), closure.targets, on_error)
    return finish_items(shaped, schema, strict, keep, fixed)


def read_catalog(spark: SparkSession, path: str, **options) -> DataFrame:
    """The item table of the catalog whose root document is the JSON file ``path``. Only files that links lead to are read, whatever their folder.

    An address that is no JSON file is an endpoint: land its responses and pass ``response_documents`` to ``read``.
    """
    if not path:
        raise ValueError("the address of the root document is empty")
    if not path.lower().endswith((".json", ".geojson")):
        raise ValueError(f"'{path}' is an endpoint, land its responses first")
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(file).toString()
    root = re.sub("^file:/+", "file:///", full)
    documents = linked_documents(spark, root)
    if documents.where(F.col("doc_uri") == root).first() is None:
        raise FileNotFoundError(f"no document '{path}'")
    return read(documents, root, **options)


def store_items(items: DataFrame, path: str, n_files: int | None = None) -> None:
    """Write the item table so that searches skip most of it: ranges of collection, place and time.

    Place is a cell of eight degrees. A collection that holds most items is cut by place and time into many ranges. The extra
    column ``crosses_antimeridian`` lets a search skip by longitude too, as the two ends of such a box say nothing on their own.
    """
    cell = F.floor((F.col("bbox.minx") + 180) / 8) * 64 + F.floor((F.col("bbox.miny") + 90) / 8)
    order = ["collection", "_cell"] + (["datetime"] if "datetime" in items.columns else []) + ["id"]
    crosses = F.coalesce(F.col("bbox.minx") > F.col("bbox.maxx"), F.lit(False))
    placed = items.withColumns({"crosses_antimeridian": crosses, "_cell": F.coalesce(cell, F.lit(-1))})
    ranged = placed.repartitionByRange(n_files, *order) if n_files else placed.repartitionByRange(*order)
    # a search for a few ids skips the row groups whose filter lacks them
    filters = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    ranged.sortWithinPartitions(*order).drop("_cell").write.options(**filters).parquet(path)
