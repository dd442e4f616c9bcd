"""Intermediate tables, kept in the shared folder that the session names.

Everything an operator needs twice is written once as Parquet below
``spark.checkpoint.dir``.  A written table cuts the lineage, survives the loss of
executors and can be read back with column pruning.  The shuffles that made it are not read again, so
their files go as soon as it is written, not when the driver happens to collect its garbage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/textloom/{app}/{label}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in here remove their shuffle files when they end; a lost one is made again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table that was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(spark: SparkSession) -> int:
    """More than shuffle partitions, so that few buckets hold much more than others."""
    return min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)


def materialise_bucketed(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Write ``df`` bucketed by ``keys``: grouping by them later moves no row.

    Rows stay in the task that writes them, so a task should have few values of the keys, or be one of
    ``bucket_count`` partitions by them.
    """
    spark = df.sparkSession
    name = f"textloom_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", scratch_path(spark, label))
    with shuffles_dropped(spark):
        writer.bucketBy(bucket_count(spark), *keys).saveAsTable(name)
    return spark.table(name)
