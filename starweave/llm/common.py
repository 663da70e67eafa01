"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Frames made and run inside release their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def persist(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared directory and read it
    back: lineage is cut, a lost executor costs nothing before this point, and
    the shuffle files of the job that wrote it are released."""
    path = new_table_path(spark, name)
    with releasing(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


UNKNOWN_BYTES = 1 << 55     # Catalyst's default for a source without statistics is above


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame (file sizes for a scan), 0 where
    it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else 0


def partitions_for(spark: SparkSession, nbytes: int, each: int = 8 << 20) -> int:
    """Shuffle partitions for a stage: the session's number, or more when one
    partition would otherwise hold over ``each`` bytes of the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-nbytes // each))


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast when it holds at most ``max_rows`` rows
    (counted, on a persisted frame), unchanged otherwise: the plain join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def sizes(texts: pa.Array, rows: int, nbytes: int) -> Iterator[tuple[int, int]]:
    """(start, length) of slices of at most ``rows`` rows and about ``nbytes``;
    a longer text is alone."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    a = total = 0
    for z, n in enumerate(size.tolist()):
        if z > a and (z - a >= rows or total + n > nbytes):
            yield a, z - a
            a, total = z, 0
        total += n
    if a < len(texts):
        yield a, len(texts) - a


def give_back() -> None:
    """Memory that Python, Arrow and the C library hold without need goes back
    to the system; an idle worker would otherwise keep the peak of its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, giving memory back at its end."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    task.__name__ = run.__name__
    return task
