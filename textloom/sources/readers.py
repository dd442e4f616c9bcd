"""Reading corpora: named tables with splits, plain files, and prepared data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.order import global_position
from textloom.sources.scratch import materialise

READ_ORDER = ["_file", "_block", "_line"]

# The file formats that can be told by their extension.
EXTENSIONS = {"csv": "csv", "json": "json", "jsonl": "json", "txt": "text", "parquet": "parquet"}


CATALOGUE = "name string, config string, split string, path string"


def register_corpus(
    spark: SparkSession, folder: str, name: str, splits: Mapping[str, str], config: str = "default"
) -> None:
    """Enter the folders of a corpus' splits under one of its configurations; later entries replace earlier ones."""
    rows = [(name, config, split, path) for split, path in splits.items()]
    added = F.current_timestamp().alias("added")
    entry = spark.createDataFrame(rows, CATALOGUE).select("*", added)
    entry.coalesce(1).write.mode("append").parquet(f"{folder}/catalogue")


def resolve_corpus(
    spark: SparkSession, folder: str, name: str, config: str | None = None
) -> dict[str, str]:
    """The folder of each split of a registered corpus.

    Without a ``config`` there must be a single one, or one called ``default``.
    """
    entries = spark.read.parquet(f"{folder}/catalogue").where(F.col("name") == name)
    # A corpus has a handful of configurations and splits.
    newest = entries.groupBy("config", "split").agg(F.max_by("path", "added").alias("path")).collect()
    configs = sorted({r["config"] for r in newest})
    if config is None:
        config = configs[0] if len(configs) == 1 else "default"
    if config not in configs:
        raise ValueError(f"corpus {name!r} has the configurations {configs}, not {config!r}")
    return {r["split"]: r["path"] for r in sorted(newest) if r["config"] == config}


def load_corpus(
    spark: SparkSession,
    folder: str,
    name: str,
    split: str | None = None,
    config: str | None = None,
    registered: bool = False,
) -> DataFrame:
    """A named Parquet corpus with all its splits, or one of them.

    A ``registered`` corpus, or one with a ``config``, is looked up in the folder's catalogue.  Else the
    name is a folder, and ``split`` labels one that has no split column of its own.
    """
    if registered or config is not None:
        paths = resolve_corpus(spark, folder, name, config)
        if split is not None and split not in paths:
            raise ValueError(f"corpus {name!r} has the splits {sorted(paths)}, not {split!r}")
        merged = None
        for label, path in paths.items():
            if split in (None, label):
                df = spark.read.parquet(path).withColumn("split", F.lit(label))
                merged = df if merged is None else merged.unionByName(df)
        return merged
    df = spark.read.parquet(f"{folder}/{name}" if folder else name)
    if "split" in df.columns:
        return df if split is None else df.where(F.col("split") == split)
    return df.withColumn("split", F.lit(split or "train"))


def file_format(path: str) -> str:
    extension = path.rstrip("/").split(".")[-1]
    if extension not in EXTENSIONS:
        raise ValueError(f"cannot tell the format of {path!r} by its extension")
    return EXTENSIONS[extension]


def load_files(
    spark: SparkSession,
    train: str | None = None,
    validation: str | None = None,
    schema: str | None = None,
    keep_linebreaks: bool = False,
    ordered: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Training and validation files as one table with a ``split`` column.

    The format follows the extension of the training file, else of the validation file.  A
    CSV cell may span lines, unless ``multi_line`` is off, which lets large files be read in parts; a
    text file gives one row per line.  ``ordered`` adds ``pos``, the
    position in the order of the files and of the rows within them.
    """
    files = {"train": train, "validation": validation}
    given = {split: path for split, path in files.items() if path is not None}
    if not given:
        raise ValueError("name a training or a validation file")
    kind = file_format(next(iter(given.values())))
    merged = None
    for split, path in given.items():
        df = _read(spark, kind, path, schema, keep_linebreaks, ordered, multi_line)
        df = df.withColumn("split", F.lit(split))
        merged = df if merged is None else merged.unionByName(df)
    if not ordered:
        return merged
    # The order columns hold for one scan only, so the rows are written before they are ranked.
    # No two rows of a scan have the same id.
    return global_position(
        materialise(merged, "files"), READ_ORDER, parts=["split"], unique=True
    ).drop(*READ_ORDER)


def _read(
    spark: SparkSession,
    kind: str,
    path: str,
    schema: str | None,
    keep_linebreaks: bool,
    ordered: bool,
    multi_line: bool,
) -> DataFrame:
    reader = spark.read if schema is None or kind == "text" else spark.read.schema(schema)
    if kind == "csv":
        df = reader.csv(path, header=True, multiLine=multi_line, escape='"', quote='"')
    elif kind == "json":
        df = reader.json(path)
    elif kind == "text":
        df = reader.text(path).withColumnRenamed("value", "text")
    else:
        df = reader.parquet(path)
    if ordered:
        # Within a block of a file the ids ascend; they order rows and are no positions.
        places = ["_metadata.file_path", "_metadata.file_block_start"]
        values = [*map(F.col, places), F.monotonically_increasing_id()]
        df = df.withColumns(dict(zip(READ_ORDER, values)))
    if kind == "text" and keep_linebreaks:
        df = df.withColumn("text", F.concat("text", F.lit("\n")))
    return df


def spread(df: DataFrame, scan: DataFrame, *keys: str) -> DataFrame:
    """Redistribute the rows of a small table before CPU-heavy work.

    ``scan`` is the table as it was read.  With two input splits per core or more, nothing is
    moved; a table of few splits would leave most cores idle.
    """
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if scan.rdd.getNumPartitions() >= wanted else df.repartition(wanted, *keys)


def load_prepared(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """Data that is prepared already; fails if a required column is missing."""
    df = spark.read.parquet(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"prepared data at {path!r} lacks {missing}")
    return df


def pick_text(df: DataFrame, column: str = "text", fallback_first: bool = False) -> str:
    """The name of the text column; the first column stands in for a missing one if wanted."""
    if column in df.columns:
        return column
    if fallback_first and df.columns:
        return df.columns[0]
    raise ValueError(f"no column {column!r} among {df.columns}")
