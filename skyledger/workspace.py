"""Where intermediate tables are written.

Closures (link levels, page chains) need their lineage cut. Each step is written once as Parquet below the shared folder that
the session names in ``spark.checkpoint.dir``. A written table survives the loss of executors, keeps its column pruning, and
gives Catalyst a real size, so a join against it is broadcast only when that size is below the session's threshold.

A lazily read result needs its tables. ``remove_all`` removes those of a session once its results are written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: used by a local master only, and only where the session names no folder
LOCAL_FOLDER = "/tmp/checkpoints"
_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. A local master that names none gets a fixed one, any other must name it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = LOCAL_FOLDER
    return root.rstrip("/")


def remove(spark: SparkSession, root: str) -> None:
    """Remove a folder of intermediate tables."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_all(spark: SparkSession) -> None:
    """Remove every intermediate table that this session has written. Results that were not written elsewhere are lost."""
    for root in _MADE.pop(spark.sparkContext.applicationId, []):
        remove(spark, root)


class Workspace:
    """One closure's intermediate tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/skyledger-{uuid.uuid4().hex}"
        _MADE.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def write(self, df: DataFrame, name: str, **counters) -> tuple[str, dict[str, int]]:
        """Write ``df`` and return its path with row counters, all in one job."""
        path = f"{self.root}/{name}"
        seen = Observation(name)
        counters = {"n_rows": F.count(F.lit(1)), **counters}
        df.observe(seen, *[c.alias(k) for k, c in counters.items()]).write.parquet(path)
        return path, seen.get

    def read(self, schema, *paths: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths)

    def materialize(self, df: DataFrame, name: str, **counters) -> tuple[DataFrame, dict[str, int]]:
        path, counts = self.write(df, name, **counters)
        return self.read(df.schema, path), counts
