"""Training batches: padding, response-only label masks, and what to do with broken rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.labels import (
    IGNORE,
    attend_through,
    bind,
    keep_through,
    last_other,
    list_offsets,
    mask_answers,
    to_lists,
)

# Rows that one call pads, in whole batches.
RUN_ROWS = 256


def collate_causal(
    df: DataFrame, batch_size: int, pad_id: int, ids: str = "input_ids", keep: Sequence[str] = ()
) -> DataFrame:
    """Add ``batch_no`` and pad ids, attention and labels to the longest row of the batch.

    ``df`` has ``split, pos`` and ids.  Rows are grouped by runs of ``RUN_ROWS``, in whole batches, and
    padded there: ids are shuffled once, and no window sorts or buffers them.
    """
    per_run = max(1, RUN_ROWS // batch_size)
    number = F.call_function("div", "pos", F.lit(batch_size)).alias("batch_no")
    rows = df.select("split", "pos", *keep, number, F.col(ids).alias("input_ids"))
    lists = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [rows.schema[c] for c in ("split", "pos", *keep, "batch_no")]
        + [T.StructField(c, lists) for c in ("input_ids", "attention_mask", "labels")]
    )
    names = ["split", "pos", *keep, "batch_no"]

    def pad(run: pa.Table) -> pa.Table:
        column = run["input_ids"].combine_chunks()
        offsets, lengths = list_offsets(column)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        _, batch = np.unique(run["batch_no"].to_numpy(), return_inverse=True)
        longest = np.zeros(batch.max() + 1, dtype=np.int64)
        np.maximum.at(longest, batch, lengths)
        ends = np.concatenate(([0], np.cumsum(longest[batch])))
        # Where each id goes in its padded row.
        places = np.arange(len(flat)) + np.repeat(ends[:-1] - offsets[:-1], lengths)
        padded = np.full(ends[-1], pad_id, dtype=np.int32)
        padded[places] = flat
        attention = np.zeros(ends[-1], dtype=np.int32)
        attention[places] = 1
        labels = np.where(padded == pad_id, IGNORE, padded)
        padded_lists = (to_lists(ends, values) for values in (padded, attention, labels))
        return pa.table([*(run[c] for c in names), *padded_lists], names=schema.names)

    lead = F.call_function("div", "batch_no", F.lit(per_run))
    return rows.groupBy("split", lead).applyInArrow(pad, schema)


def restore_eos(df: DataFrame, eos_id: int, pad_id: int) -> DataFrame:
    """Undo the masking of real end-of-sequence tokens where they double as padding.

    ``df`` is a collated batch.  The hidden tokens up to one past the last other id come back;
    a row of nothing but that token is left as it is.
    """
    if eos_id != pad_id:
        return df
    ids, attention = F.col("input_ids"), F.col("attention_mask")
    restored = bind(
        last_other(ids, eos_id),
        lambda last: F.struct(
            keep_through(ids, last).alias("labels"),
            attend_through(attention, last).alias("attention"),
        ),
    )
    return (
        df.withColumn("_row", restored)
        .withColumns({"attention_mask": F.col("_row.attention"), "labels": F.col("_row.labels")})
        .drop("_row")
    )


def response_mask(
    df: DataFrame,
    marker: Sequence[int],
    eos_id: int,
    pad_id: int,
    skip_mismatched: bool = False,
    counts: Observation | None = None,
) -> DataFrame:
    """Keep only answer labels of a collated batch, end tokens restored as in ``restore_eos``.

    ``well_formed`` tells whether markers and ends pair up; rows where they do not are dropped
    if ``skip_mismatched``, else masked by the pairs there are.  ``counts`` has ``rows`` and ``failed``
    after the first run of the result, without a run of its own.
    """
    row = mask_answers(
        F.col("input_ids"), F.col("attention_mask"), marker, eos_id, pad_id, skip_mismatched
    )
    masked = df.withColumn("_row", row)
    if counts is not None:
        failed = F.count_if(~F.col("_row.well_formed"))
        masked = masked.observe(counts, F.count(F.lit(1)).alias("rows"), failed.alias("failed"))
    if skip_mismatched:
        masked = masked.where("_row.well_formed")
    return masked.withColumns(
        {
            "attention_mask": F.col("_row.attention"),
            "labels": F.col("_row.labels"),
            "well_formed": F.col("_row.well_formed"),
        }
    ).drop("_row")


def mismatch_counts(masked: DataFrame) -> DataFrame:
    """Rows and badly paired rows per batch."""
    return masked.groupBy("split", "batch_no").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("well_formed")).alias("failed")
    )
