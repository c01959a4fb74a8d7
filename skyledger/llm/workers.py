"""Where Python workers find this package."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def find_package(spark: SparkSession) -> None:
    """Let workers started from now on import the package from where the driver has it. On a cluster it is installed or sent with the job."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, known]).rstrip(os.pathsep)


#: bytes of an Arrow batch; Spark holds one some four times over outside its heap, its worker up to twice
BATCH, _BATCH_SETTING = 1 << 21, "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """From now on this session's tasks get Arrow batches of at most BATCH bytes, or one row, where 10,000 rows are as large as their texts. A bound that the session names itself stays."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH))


def give_back_pages() -> None:
    """Return what allocators keep of freed memory to the machine. Without it a worker grows by what its slices have taken, not only by what one of them takes."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # another C library than glibc


def give_back() -> None:
    """Return free memory of a worker, which serves later tasks too, to the machine."""
    gc.collect()
    give_back_pages()


#: what drops the caches that operators keep in a worker
_CACHES: list[Callable[[], object]] = []


def keeps(drop: Callable[[], object]) -> None:
    """An operator's module keeps a cache in its workers; ``drop`` empties it."""
    _CACHES.append(drop)


def drop_caches() -> None:
    """Empty the caches that tasks of other operators have left in this worker."""
    for drop in _CACHES:
        drop()


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task on Arrow batches that begins without the caches of others and gives back its memory when it is done."""

    def run(batches: Iterator) -> Iterator:
        drop_caches()
        yield from task(batches)
        give_back()

    return run


def with_bounded_batches(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function of a session whose tasks get Arrow batches of bounded size, also where its result is read later."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        bound_batches(spark)
        return query(spark, *args)

    return run


def with_package(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function of a session whose workers find the package."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        find_package(spark)
        return query(spark, *args)

    return run
