"""Several chat sets in their own formats, merged into one table of dialogs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from textloom.operators.dialogs import concat_positions, size_report
from textloom.sources.writers import publish_version, read_published


@dataclass(frozen=True)
class ChatSet:
    """How a set is read, given the observation that counts its rejects, and the key it is ordered by."""

    read: Callable[[Observation], DataFrame]
    order: str | Sequence[str]


def merge_chat_sets(
    spark: SparkSession, inputs: Mapping[str, ChatSet], target: str, drop: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The dialogs of all inputs, published in their order, and ``source, rows, rejects``.

    Both are read from what was published: no input is read again for the report, and rejected rows
    were counted while the others were written.  ``drop`` names columns that only give the order.
    """
    counts = {source: Observation() for source in inputs}
    placed = [(chat.read(counts[source]), chat.order) for source, chat in inputs.items()]
    merged = concat_positions(placed)
    version = publish_version(merged.drop(*drop), target)
    published = read_published(spark, target, version)
    return published, size_report(published, counts)
