"""Positions and running totals over a whole table, without a single-task sort.

Row order carries meaning here (head splits, batches, ties), so it is a column: ``pos``,
0-based within each part.  Three ways lead to it, cheapest first:

* ``file_position``   rows keep the order of the files they were read from; no shuffle.
* dense integer key   ``pos = key - min(key)`` once the key is proven dense; no shuffle.
* anything else       the keys alone are range-partitioned by the full sort key and written
  to the shared folder.  The driver sees two totals per range and nothing else.

Ranges follow the unique sort key, so a value that holds a third of all rows is spread over
as many ranges as its rows need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.sources.scratch import materialise

MAX_DRIVER_ROWS = 100_000


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _dense_start(df: DataFrame, key: str) -> int | None:
    """The smallest key if the keys are exactly ``min .. min + n - 1``, else None."""
    if not isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return None
    low, high, rows, keyed = df.agg(
        F.min(key), F.max(key), F.count(F.lit(1)), F.count(key)
    ).first()
    if rows == 0:
        return 0
    if keyed != rows or high - low + 1 != rows:
        return None
    # Only the keys are shuffled, and equal ones are counted together before that.
    distinct = df.agg(F.count_distinct(key)).first()[0]
    return low if distinct == rows else None


def running_total(
    df: DataFrame,
    order: str | Sequence[str],
    value: Column,
    parts: Sequence[str] = (),
    descending: Sequence[str] = (),
    name: str = "start",
    whole: str | None = None,
) -> DataFrame:
    """``parts + order + name``: the sum of ``value`` over all earlier rows of the part.

    ``whole`` names a further column for the sum over the whole part.  ``order`` must be unique
    within a part.  There may be any number of parts, of any size.
    """
    order, parts = _names(order), list(parts)
    spark = df.sparkSession
    sort = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(*parts, *order, value.cast("long").alias("_value"))
    ranged = materialise(
        keys.repartitionByRange(ranges, *[F.col(c).asc() for c in parts], *sort).withColumn(
            "_range", F.spark_partition_id()
        ),
        "order",
    )
    here = Window.partitionBy(*parts, "_range")
    upto = here.orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("_value").over(upto) - F.col("_value")
    carried = _carried(ranged, parts)
    carried = carried.toDF(*[f"_of_{c}" for c in (*parts, "_range")], "_base", "_whole")
    placed = ranged.join(F.broadcast(carried), _same([*parts, "_range"]), "left")
    columns = [*parts, *order, (F.coalesce("_base", F.lit(0)) + before).alias(name)]
    if whole:
        columns.append(F.coalesce("_whole", F.sum("_value").over(here)).alias(whole))
    return placed.select(*columns)


def _same(columns: Sequence[str]) -> Column:
    """Rows agree with the ``_of_`` columns of the other side, null with null."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return same


def _carried(ranged: DataFrame, parts: list[str]) -> DataFrame:
    """``parts, _range, _base, _whole`` for the parts that reach over a border of ranges.

    Ranges are contiguous, so only the first and the last part of a range can do so: the driver
    sees two totals per range and returns at most two rows per range.
    """
    totals = ranged.groupBy(*parts, "_range").agg(F.sum("_value").alias("_total"))
    edges = (
        totals.groupBy("_range")
        .agg(
            F.min(F.struct(*parts, "_total")).alias("first"),
            F.max(F.struct(*parts, "_total")).alias("last"),
        )
        .collect()
    )
    pieces: dict[tuple, list[tuple[int, int]]] = {}
    for edge in sorted(edges, key=lambda e: e["_range"]):
        for row in {edge["first"], edge["last"]}:
            pieces.setdefault(tuple(row)[:-1], []).append((edge["_range"], row["_total"]))
    rows = []
    for part, totals_of in pieces.items():
        if len(totals_of) > 1:
            base, all_of = 0, sum(t for _, t in totals_of)
            for number, total in totals_of:
                rows.append((*part, number, base, all_of))
                base += total
    schema = T.StructType(
        [T.StructField(c, ranged.schema[c].dataType) for c in parts]
        + [T.StructField("_range", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("_base", "_whole")]
    )
    return ranged.sparkSession.createDataFrame(rows, schema)


def global_position(
    df: DataFrame,
    order: str | Sequence[str],
    parts: Sequence[str] = (),
    descending: Sequence[str] = (),
    name: str = "pos",
    unique: bool = False,
) -> DataFrame:
    """Add the 0-based position of every row within its part under a unique sort key.

    No row is lost: null parts and null keys are values like others.  A sort key that repeats
    within a part would not tell which of its rows comes first: with further columns it is refused
    with an error, unless the caller knows it to be ``unique``.
    """
    order, parts = _names(order), list(parts)
    if not parts and len(order) == 1 and not descending:
        first = _dense_start(df, order[0])
        if first is not None:
            return df.withColumn(name, F.col(order[0]).cast("long") - F.lit(first))
    placed = running_total(df, order, F.lit(1), parts, descending, name)
    if set(df.columns) == {*parts, *order}:
        return placed
    if not unique:
        keys = df.select(*parts, *order).groupBy(*parts, *order).agg(F.count(F.lit(1)).alias("_n"))
        if not keys.where(F.col("_n") > 1).isEmpty():
            raise ValueError(f"{order} repeats within {parts or 'the table'}: rows have no position")
    placed = placed.toDF(*[f"_of_{c}" for c in (*parts, *order)], name)
    return df.join(placed, _same([*parts, *order])).select(*df.columns, name)


def file_position(df: DataFrame, name: str = "pos") -> DataFrame:
    """Position by file name, then row within the file, for a freshly read Parquet table."""
    placed = df.withColumns(
        {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    )
    return row_position(placed, name)


def row_position(df: DataFrame, name: str = "pos") -> DataFrame:
    """Position by ``_file``, then ``_row``, the row's number within its file; both are dropped.

    Every file has all its rows here.  The sums run in two levels, over the files of a range and
    over ranges, so there may be any number of files: none of their names reaches the driver.
    """
    sizes = df.groupBy("_file").agg((F.max("_row") + 1).alias("_rows"))
    bases = running_total(sizes, "_file", F.col("_rows"), name="_base").withColumnRenamed("_file", "_of")
    placed = df.join(bases, F.col("_file") == F.col("_of"))
    return placed.withColumn(name, F.col("_base") + F.col("_row")).drop("_file", "_row", "_base", "_of")
