"""Writing prepared corpora, merged chat tables and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import path_tail


def prepared_path(out: str, name: str, config: str | None, tokenizer: str, block_size: int) -> str:
    """``<out>/<tail of name>--<config>-<tail of tokenizer>-<block size>``."""
    return f"{out}/{path_tail(name)}--{config}-{path_tail(tokenizer)}-{block_size}"


def save_prepared(df: DataFrame, path: str) -> str:
    """One folder per split, so that a reader of one split skips the others."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def publish(df: DataFrame, target: str, table: bool = False) -> None:
    """Publish the merged chat table as Parquet files or as a catalog table, in place of what is there."""
    writer = df.write.mode("overwrite")
    writer.saveAsTable(target) if table else writer.parquet(target)


VERSIONS = "version long, path string, rows long"


def publish_version(df: DataFrame, target: str) -> int:
    """Publish a table as the next version of ``target``, and return its number.

    The rows are written and counted first; the version exists for readers only when the one file that
    names it is there, so they see all of it or what was published before.  A write that fails, or is
    repeated, leaves nothing that a reader would find.
    """
    spark = df.sparkSession
    # An empty list of versions, unless there is one.
    spark.createDataFrame([], VERSIONS).write.mode("ignore").parquet(f"{target}/versions")
    number = 1 + (versions(spark, target).agg(F.max("version")).first()[0] or 0)
    path = f"{target}/data/version={number}"
    counts = Observation()
    df.observe(counts, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    entry = spark.createDataFrame([(number, path, counts.get["rows"])], VERSIONS)
    entry.coalesce(1).write.mode("append").parquet(f"{target}/versions")
    return number


def versions(spark: SparkSession, target: str) -> DataFrame:
    """``version, path, rows`` of what was published."""
    return spark.read.schema(VERSIONS).parquet(f"{target}/versions")


def read_published(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The newest version of a published table, or the one asked for."""
    known = versions(spark, target)
    if version is not None:
        known = known.where(F.col("version") == version)
    newest = known.orderBy(F.col("version").desc()).first()
    if newest is None:
        raise ValueError(f"{target!r} has no published version {'' if version is None else version}".rstrip())
    return spark.read.parquet(newest["path"])


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)
