"""Expressions over token ids: padding, restored end tokens and label masks.

Ignored labels are -100.  Everything is linear in the row's length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the label that a loss skips.
IGNORE = -100
# Ids that one call masks: its working arrays take some 60 bytes an id.
PIECE_IDS = 1 << 20


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def last_other(ids: Column, token: int) -> Column:
    """0-based index of the last id that is not ``token``; -1 if there is none."""
    other = F.transform(ids, lambda v: v != token)
    from_end = F.array_position(F.reverse(other), F.lit(True))
    return F.when(from_end == 0, -1).otherwise(F.size(ids) - from_end).cast("int")


def keep_through(ids: Column, last: Column) -> Column:
    """Labels equal to the ids up to one past ``last``, ignored beyond; all ignored if -1."""
    kept = F.when(last < 0, 0).otherwise(F.least(F.size(ids), last + 2))
    return F.concat(F.slice(ids, F.lit(1), kept), F.array_repeat(F.lit(IGNORE), F.size(ids) - kept))


def attend_through(attention: Column, last: Column) -> Column:
    """Right-padded attention, extended to one past ``last``."""
    first_zero = F.array_position(attention, F.lit(0)).cast("int")
    ones = F.when(first_zero == 0, F.size(attention)).otherwise(first_zero - 1)
    reach = F.when(last < 0, ones).otherwise(
        F.greatest(ones, F.least(F.size(attention), last + 2))
    )
    return F.concat(
        F.array_repeat(F.lit(1), reach), F.array_repeat(F.lit(0), F.size(attention) - reach)
    )


MASK_TYPE = T.StructType(
    [
        T.StructField("labels", T.ArrayType(T.IntegerType())),
        T.StructField("attention", T.ArrayType(T.IntegerType())),
        T.StructField("well_formed", T.BooleanType()),
    ]
)


def mask_answers(
    ids: Column,
    attention: Column,
    marker: Sequence[int],
    eos_id: int,
    pad_id: int,
    filtered: bool = False,
) -> Column:
    """``struct<labels, attention, well_formed>`` of padded rows, answers kept as labels.

    An answer reaches from just after a marker through the end token paired with it; the i-th
    marker goes with the i-th end, and the shorter list decides.  A row is well formed if there
    are as many of one as of the other.

    Works on the flat values of a whole Arrow batch: Spark interprets higher-order functions
    element by element, and the same mask built from them took about four times as long.
    Batches are masked in pieces of ``PIECE_IDS`` ids, so that memory does not follow their size.
    ``filtered`` says that a filter on the result follows: it then stays above the function
    instead of being pushed through it, which would compute every mask twice.
    """
    marker = [int(m) for m in marker]
    if not marker:
        raise ValueError("the marker must have at least one token")

    def mask_rows(ids: pa.Array, attention: pa.Array) -> pa.Array:
        offsets, lengths = list_offsets(ids)
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        attended = attention.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lengths)), lengths)
        at = np.arange(len(flat)) - offsets[row]
        if eos_id == pad_id:
            # Real end tokens are those up to one past the last other token.
            last = np.full(len(lengths), -2)
            other = np.flatnonzero(flat != eos_id)
            np.maximum.at(last, row[other], at[other])
            real = at <= last[row] + 1
            attended = np.where(real, 1, attended)
        else:
            real = flat != pad_id
        labels = np.where(real, flat, IGNORE)

        hit = at + len(marker) <= lengths[row]
        for step, token in enumerate(marker):
            hit[: len(labels) - step] &= labels[step:] == token
        begins = np.flatnonzero(hit) + len(marker)
        stops = np.flatnonzero(labels == eos_id) + 1
        begin_counts = np.bincount(row[hit], minlength=len(lengths))
        stop_counts = np.bincount(row[stops - 1], minlength=len(lengths))
        pairs = np.minimum(begin_counts, stop_counts)
        begins = begins[_nth_in_row(begin_counts) < np.repeat(pairs, begin_counts)]
        stops = stops[_nth_in_row(stop_counts) < np.repeat(pairs, stop_counts)]
        spans = begins < stops
        depth = np.bincount(begins[spans], minlength=len(labels) + 1) - np.bincount(
            stops[spans], minlength=len(labels) + 1
        )
        labels = np.where(np.cumsum(depth)[:-1] > 0, labels, IGNORE)
        return pa.StructArray.from_arrays(
            [
                to_lists(offsets, labels),
                to_lists(offsets, attended),
                pa.array(begin_counts == stop_counts),
            ],
            names=MASK_TYPE.names,
        )

    @F.arrow_udf(MASK_TYPE)
    def mask(ids: pa.Array, attention: pa.Array) -> pa.Array:
        runs = runs_of(list_offsets(ids)[1], PIECE_IDS) or [(0, 0)]
        return pa.concat_arrays([mask_rows(ids[at:stop], attention[at:stop]) for at, stop in runs])

    return (mask.asNondeterministic() if filtered else mask)(ids, attention)


def runs_of(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """First row and end of runs of rows of at most ``most`` in size, or of one larger row."""
    ends, runs, at, before = np.cumsum(sizes, dtype=np.int64), [], 0, 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        runs.append((at, stop))
        at, before = stop, int(ends[stop - 1])
    return runs


def _nth_in_row(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each row, for rows of the given numbers of items."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def list_offsets(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and lengths of the lists in their flattened values; a null list has length 0."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(lengths))), lengths


def to_lists(offsets: np.ndarray, flat: np.ndarray, nulls: pa.Array | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(offsets, type=pa.int32()), pa.array(flat, type=pa.int32()), mask=nulls
    )


def nulls_of(array: pa.Array) -> pa.Array | None:
    return array.is_null() if array.null_count else None
