"""Catalog files read by their links: each level reads the files that the level before links, wherever they lie, and no others."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.uri import is_static
from skyledger.operators.links import container_nodes
from skyledger.sources.documents import file_address
from skyledger.workspace import Workspace

#: addresses that one read is given; Spark's own list of files for a folder is as long as the folder
AT_ONCE = 20_000
#: local files that a task opens, and bytes of them that it holds
IN_A_TASK, HELD = 4_000, 4 << 20
DOCUMENTS = "doc_uri string, body string"


def _exists(spark: SparkSession, path: str) -> bool:
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file)


def _files(spark: SparkSession, addresses: list[str]) -> DataFrame | None:
    """The files at these addresses, whole; None without any. Those that don't exist are left out."""

    def read(paths: list[str]) -> DataFrame:
        # an address is no pattern
        found = spark.read.text([re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths], wholetext=True)
        return found.select(file_address(F.col("_metadata.file_path")).alias("doc_uri"), F.col("value").alias("body"))

    try:
        return read(addresses)
    except AnalysisException as wrong:
        if wrong.getCondition() != "PATH_NOT_FOUND":
            raise
    there = [a for a in addresses if _exists(spark, a)]
    return read(there) if there else None


def _is_local(address: Column) -> Column:
    return address.rlike("^file:(/|///+)[^/]")


def _local_files(addresses: DataFrame, n: int) -> DataFrame:
    """The files of a table of ``n`` local addresses, whole. Tasks open them, so there is no list of files and no split for each. What Spark's readers pass over has
    no row here either: files that don't exist, empty ones and hidden ones."""

    def read(batches):
        import os
        import re

        import pyarrow as pa

        def batch(names, bodies):
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], ["doc_uri", "body"])

        names, bodies, held = [], [], 0
        for part in batches:
            for address in part.column(0).to_pylist():
                path = re.sub("^file:/+", "/", re.sub("/+", "/", address))
                name = path.rpartition("/")[2]
                if name.startswith(".") or (name.startswith("_") and "=" not in name) or os.path.isdir(path):
                    continue
                try:
                    with open(path, "rb") as file:
                        body = file.read()
                except FileNotFoundError:
                    continue
                if body:
                    names.append(f"file://{path}")
                    bodies.append(body)
                    held += len(body)
                if held >= HELD:
                    yield batch(names, bodies)
                    names, bodies, held = [], [], 0
        yield batch(names, bodies)

    tasks = min(n, max(addresses.sparkSession.sparkContext.defaultParallelism, math.ceil(n / IN_A_TASK)))
    found = addresses.select("doc_uri").repartition(max(1, tasks)).mapInArrow(read, "doc_uri string, body binary")
    return found.select("doc_uri", F.col("body").cast("string").alias("body"))


def _in_parts(rows: Iterator, n: int) -> Iterator[list[str]]:
    while part := [r[0] for r in islice(rows, n)]:
        yield part


def linked_documents(spark: SparkSession, root: str, at_once: int = AT_ONCE) -> DataFrame:
    """The JSON files that links of catalogs, collections and pages lead to from the file ``root``, in any folder, as (doc_uri, body).

    A level is one read of local files, and a few reads of ``at_once`` files each for those elsewhere; what it read is written, and its links without those asked for
    before are the next level. So circles end, each file is read once, and the driver holds ``at_once`` addresses at a time. Links to anything but JSON files are left alone; a link to a file
    that does not exist gives no row here, and is reported by what follows the links.
    """
    work = Workspace(spark)
    count = {"n_local": F.count_if(_is_local(F.col("doc_uri")))}
    wanted, seen = work.materialize(spark.createDataFrame([(root,)], "doc_uri string"), "wanted-0", **count)
    asked, read, level = [f"{work.root}/wanted-0"], [], 0
    while True:
        new = []
        if seen["n_local"]:
            path, n = work.write(_local_files(wanted.where(_is_local(F.col("doc_uri"))), seen["n_local"]), f"documents-{level}-local")
            new += [path] if n["n_rows"] else []
        others = wanted.where(~_is_local(F.col("doc_uri"))).toLocalIterator() if seen["n_rows"] > seen["n_local"] else iter(())
        for k, addresses in enumerate(_in_parts(others, at_once)):
            files = _files(spark, addresses)
            if files is not None:
                # small files come many to a partition; parsing them is far more work than reading
                new.append(work.write(files, f"documents-{level}-{k}")[0])
        if not new:
            break
        read += new
        nodes = container_nodes(work.read(DOCUMENTS, *new))
        links = F.concat(F.transform("child_links", lambda l: l["dst"]), F.transform("item_links", lambda l: l["dst"]), F.array("next_uri"))
        targets = nodes.select(F.explode(links).alias("doc_uri")).where(is_static(F.col("doc_uri")) & ~F.col("doc_uri").rlike("^[hH][tT][tT][pP][sS]?:"))
        level += 1
        wanted, seen = work.materialize(targets.distinct().join(work.read("doc_uri string", *asked), "doc_uri", "left_anti"), f"wanted-{level}", **count)
        if not seen["n_rows"]:
            break
        asked.append(f"{work.root}/wanted-{level}")
    return work.read(DOCUMENTS, *read) if read else spark.createDataFrame([], DOCUMENTS)
