"""Train / validation splits and head samples; rows carry ``split`` and a 0-based ``pos``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN, VALIDATION = "train", "validation"


def head_percent_split(df: DataFrame, pct: float = 5, total: int | None = None) -> DataFrame:
    """The first ``pct`` percent of rows become validation, the rest train.

    The border is rounded half to even; ``pos`` restarts at 0 in each split.  ``total`` may
    be given when the row count is known already.
    """
    if df.isStreaming:
        raise ValueError("a stream has no row count: give it a validation split instead")
    total = df.count() if total is None else total
    border = F.bround(F.lit(float(total)) * F.lit(float(pct)) / F.lit(100.0)).cast("long")
    held_out = F.col("pos") < border
    return df.withColumns(
        {
            "split": F.when(held_out, VALIDATION).otherwise(TRAIN),
            "pos": F.when(held_out, F.col("pos")).otherwise(F.col("pos") - border),
        }
    )


def with_validation(
    df: DataFrame,
    pct: float = 5,
    use_presplit: bool = True,
    splits: Sequence[str] | None = None,
) -> DataFrame:
    """Keep an existing validation split if wanted, else cut a new one from the train rows.

    A replaced validation split is dropped; other splits, also rows of none, are carried along.  ``splits`` names
    the splits of a stream, whose rows cannot be looked at beforehand.
    """
    if splits is not None:
        present = VALIDATION in splits
    elif df.isStreaming:
        present = False
    else:
        present = has_split(df, VALIDATION)
    if present and use_presplit:
        return df
    if df.isStreaming:
        raise ValueError(
            "a validation split cannot be cut from a stream: name one, keep the given one, or read in batch"
        )
    columns = df.columns
    train = head_percent_split(df.where(F.col("split") == TRAIN), pct).select(*columns)
    others = df.where(F.col("split").isNull() | ~F.col("split").isin(TRAIN, VALIDATION))
    return train.unionByName(others)


def has_split(df: DataFrame, split: str) -> bool:
    return not df.where(F.col("split") == split).limit(1).isEmpty()


def require_split(df: DataFrame, split: str) -> DataFrame:
    """Fail early when training or evaluation would start without its rows."""
    if not has_split(df, split):
        raise ValueError(f"no rows in the required split {split!r}")
    return df


def head_samples(df: DataFrame, caps: dict[str, int | None]) -> DataFrame:
    """Keep the first ``caps[split]`` rows of each named split; None keeps all of them."""
    keep: Column = F.lit(True)
    for split, cap in caps.items():
        if cap is not None:
            keep = keep & ((F.col("split") != split) | (F.col("pos") < cap))
    return df.where(keep)
