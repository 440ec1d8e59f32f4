"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast by hint only when its row count is known to be at most this.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. A local session without one gets
    a scratch folder; a cluster without one is an error, since a driver-local
    path would not survive the loss of an executor."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return spark.sparkContext.getCheckpointDir()


_RUNS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, inside the current run's if there is one."""
    home = _RUNS[-1] if _RUNS else f"{shared_dir(spark).rstrip('/')}/riskloom"
    return f"{home}/{name}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _file(spark, path)
    return system.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, where = _file(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(where)) if system.exists(where) else []


def version(spark: SparkSession, paths: list[str]) -> tuple:
    """Tells the present content of files and folders from any other by the
    names, sizes and times of their files. One job, which opens none of them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    found = found.select(F.xxhash64("path", "length", "modificationTime").alias("file"), "length")
    return tuple(found.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor("file")).first())


def mark(spark: SparkSession, path: str) -> None:
    """An empty file that is there from one moment on, in any store; an error if it already was."""
    system, where = _file(spark, path)
    system.create(where, False).close()


def remove(spark: SparkSession, path: str) -> None:
    system, where = _file(spark, path)
    system.delete(where, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables made inside go to one folder, which goes at the end,
    whether the run succeeds or not. Nothing lazy that reads them may leave."""
    path = scratch_path(spark, "run")
    _RUNS.append(path)
    try:
        yield path
    finally:
        _RUNS.remove(path)
        remove(spark, path)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back, so that everything downstream sees
    one fixed result, prunes columns, and does not recompute after a loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
