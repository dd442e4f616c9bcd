"""Packing whole conversations into samples of bounded length.

The greedy rule: per split, the longest unpacked conversation opens a pack; the shortest
remaining ones join it while everything plus the system prompt fits.  Sorted lengths are fully
described by their histogram, which has at most ``max_length + 1`` entries, so the rule is
played on the histogram and the resulting segments are joined back to the ranked rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import TURN_CLOSE, TURN_OPEN, lex_count, render_prompt
from textloom.operators.dialogs import DIALOG_TYPE, message
from textloom.operators.order import MAX_DRIVER_ROWS, global_position
from textloom.operators.tokens import token_length
from textloom.operators.vocab import Specials
from textloom.sources.scratch import materialise

SEGMENT_SCHEMA = (
    "split string, cell long, lo long, hi long, base long, anchor long, per_pack long, opener boolean"
)
RANK_CELLS = 4096


def dialog_lengths(
    df: DataFrame, max_length: int, specials: Specials = Specials(), dialog: str = "dialog"
) -> DataFrame:
    """``split, pos, length``: tokens of each dialog rendered without a system prompt."""
    if df.isStreaming:
        raise ValueError("packing needs all lengths: read the conversations in batch")
    prompt = render_prompt(F.col(dialog), None, specials.bos, specials.eos)
    return df.select("split", "pos", token_length(prompt, specials, max_length).alias("length"))


def turn_lengths(
    turns: DataFrame,
    max_length: int,
    specials: Specials = Specials(),
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``key, length`` of every conversation of a table with one row per turn, as ``dialog_lengths`` gives it.

    A prompt's parts are set apart by white space or by special tokens, so its tokens are the sum of
    theirs: turns are counted where they are, and only numbers are shuffled.
    """
    if turns.isStreaming:
        raise ValueError("packing needs all lengths: read the conversations in batch")
    count = lambda column: lex_count(column, specials.pattern).cast("long")
    asked = F.coalesce(F.col(role) == "user", F.lit(False))
    opening = count(F.lit(specials.bos + TURN_OPEN))
    around = F.when(asked, opening + count(F.lit(TURN_CLOSE))).otherwise(count(F.lit(specials.eos)))
    own = count(F.coalesce(text, F.lit("None"))) + around
    # The first turn opens the prompt whoever speaks, and a user does not open it again.
    first = F.when(F.min(F.struct(turn, role))[role] == "user", 0).otherwise(opening)
    length = F.least(F.sum(own) + first, F.lit(max_length)).cast("int")
    return turns.groupBy(key).agg(length.alias("length"))


def length_rank(lengths: DataFrame) -> DataFrame:
    """Add ``rank``: 0-based, longest first, ties by position."""
    return global_position(
        lengths, ["length", "pos"], parts=["split"], descending=["length"], name="rank", unique=True
    )


def plan_segments(
    histogram: Iterable[tuple[int, int]], max_length: int, system_size: int
) -> Iterator[tuple[int, int, int, int, int, bool]]:
    """Play the greedy rule on ``(length, rows)`` pairs.

    Yields ``(lo, hi, base, anchor, per_pack, opener)`` over inclusive rank ranges.  An opener
    of rank r has pack ``base + r - anchor`` and slot 0; a filler at distance d = anchor - r
    has pack ``base + d div per_pack`` and slot ``1 + d mod per_pack``.
    """
    runs, n = [], 0  # (length, first rank, last rank), longest first
    for length, rows in sorted(histogram, reverse=True):
        runs.append((length, n, n + rows - 1))
        n += rows
    first, last, pack = 0, n - 1, 0
    front, back = 0, len(runs) - 1
    while first <= last:
        while runs[front][2] < first:
            front += 1
        while runs[back][1] > last:
            back -= 1
        longest, shortest = runs[front][0], runs[back][0]
        openers = min(runs[front][2], last) - first + 1
        room = max_length - system_size - longest
        if room < shortest or first == last:
            # Nothing fits any opener of this run.
            yield first, first + openers - 1, pack, first, 1, True
            first, pack = first + openers, pack + openers
            continue
        per_pack = room // shortest if shortest > 0 else n
        if front == back:
            full = openers // (per_pack + 1)
        else:
            full = min(openers, (last - runs[back][1] + 1) // per_pack)
        if full:
            # ``full`` packs that each take exactly ``per_pack`` rows of the shortest run.
            yield first, first + full - 1, pack, first, 1, True
            yield last - full * per_pack + 1, last, pack, last, per_pack, False
            first, last, pack = first + full, last - full * per_pack, pack + full
            continue
        # One pack that uses up the shortest run and may go on into the next ones.
        yield first, first, pack, first, 1, True
        anchor = last
        while last > first:
            while runs[back][1] > last:
                back -= 1
            length = runs[back][0]
            there = last - max(runs[back][1], first + 1) + 1
            take = min(there, room // length) if length > 0 else there
            if take:
                yield last - take + 1, last, pack, anchor, n, False
                last, room = last - take, room - take * length
            if take < there:
                break
        first, pack = first + 1, pack + 1


def _cells(segments: Iterable[tuple], width: int) -> Iterator[tuple]:
    """Cut segments at multiples of ``width`` so that rows find theirs by an equi-join."""
    for lo, hi, *rest in segments:
        for cell in range(lo // width, hi // width + 1):
            yield cell, max(lo, cell * width), min(hi, (cell + 1) * width - 1), *rest


def pack_dialogs(lengths: DataFrame, max_length: int, system_size: int) -> DataFrame:
    """``split, pos, length, pack_id, slot``: every row of ``split, pos, length`` in one pack.

    The lengths are read several times: hand over a written table.
    """
    spark = lengths.sparkSession
    # At most max_length + 1 rows per split.
    histogram: dict[str, list[tuple[int, int]]] = {}
    for row in lengths.groupBy("split", "length").count().collect():
        histogram.setdefault(row["split"], []).append((row["length"], row["count"]))
    widest = max((sum(c for _, c in h) for h in histogram.values()), default=0)
    width = max(1, -(-widest // RANK_CELLS))
    segments = [
        (split, *segment)
        for split, counts in histogram.items()
        for segment in _cells(plan_segments(counts, max_length, system_size), width)
    ]
    plan = spark.createDataFrame(segments, SEGMENT_SCHEMA)
    if len(segments) <= MAX_DRIVER_ROWS:
        plan = F.broadcast(plan)
    ranked = length_rank(lengths).withColumn("cell", F.call_function("div", "rank", F.lit(width)))
    placed = ranked.join(plan, ["split", "cell"]).where(F.col("rank").between(F.col("lo"), F.col("hi")))
    distance = F.col("anchor") - F.col("rank")
    pack = F.when(F.col("opener"), F.col("base") - distance).otherwise(
        F.col("base") + F.call_function("div", distance, F.col("per_pack"))
    )
    slot = F.when(F.col("opener"), 0).otherwise(1 + distance % F.col("per_pack"))
    return placed.select(
        "split", "pos", "length", pack.alias("pack_id"), slot.cast("long").alias("slot")
    )


def merge_packs(df: DataFrame, packs: DataFrame, dialog: str = "dialog") -> DataFrame:
    """``split, pack_id, dialog``: the turns of each pack's members in slot order.

    A pack holds at most ``max_length`` tokens, which bounds every group.
    """
    members = F.array_sort(F.collect_list(F.struct("slot", dialog)))
    return (
        df.select("split", "pos", dialog)
        .join(packs.select("split", "pos", "pack_id", "slot"), ["split", "pos"])
        .groupBy("split", "pack_id")
        .agg(members.alias("_members"))
        .select(
            "split",
            "pack_id",
            F.flatten(F.transform("_members", lambda m: m[dialog])).alias(dialog),
        )
    )


def merge_turns(
    turns: DataFrame,
    packs: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``split, pack_id, dialog`` from a table with one row per turn; ``packs`` also has its ``key``.

    Turns go to their pack at once, in the order of slots and turns, so their texts are shuffled at
    most twice: to meet their pack's number, and to the pack.
    """
    numbers = packs.select(F.col(key).alias("_key"), "split", "pack_id", "slot")
    placed = turns.select(key, turn, role, text).join(numbers, F.col(key).eqNullSafe(F.col("_key")))
    members = F.array_sort(F.collect_list(F.struct("slot", turn, role, text)))
    messages = F.transform("_turns", lambda t: message(t[role], t[text])).cast(DIALOG_TYPE)
    return (
        placed.groupBy("split", "pack_id")
        .agg(members.alias("_turns"))
        .select("split", "pack_id", messages.alias("dialog"))
    )


def pack_violations(packs: DataFrame, max_length: int) -> DataFrame:
    """Per split: packs, the fullest one, and those whose members alone exceed ``max_length``."""
    return (
        packs.groupBy("split", "pack_id")
        .agg(F.sum("length").alias("tokens"))
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("packs"),
            F.max("tokens").alias("most_tokens"),
            F.count_if(F.col("tokens") > max_length).alias("violations"),
        )
    )


def pack_coverage(lengths: DataFrame, packs: DataFrame) -> DataFrame:
    """Per split: rows, rows without a pack, and rows with more than one."""
    placed = packs.groupBy("split", "pos").agg(F.count(F.lit(1)).alias("times"))
    times = F.coalesce(F.col("times"), F.lit(0))
    return (
        lengths.join(placed, ["split", "pos"], "left")
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(times == 0).alias("missing"),
            F.count_if(times > 1).alias("repeated"),
        )
    )


def pack_report(packs: DataFrame, max_length: int) -> DataFrame:
    """Rows before and after packing, and the share of the packs' room that is used."""
    return (
        packs.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("rows_before"),
            F.count_if(F.col("slot") == 0).alias("rows_after"),
            F.sum("length").alias("tokens"),
        )
        .withColumn("fill_ratio", F.col("tokens") / (F.col("rows_after") * max_length))
    )
