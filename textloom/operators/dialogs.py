"""One dialog schema for chat data: ``dialog array<struct<role, content>>`` and ``source``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textloom.functions.text import literal_pattern, strip
from textloom.operators.order import global_position
from textloom.sources.scratch import materialise

DIALOG_TYPE = "array<struct<role:string,content:string>>"


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def counted(df: DataFrame, counts: Observation | None, rejected: Column) -> DataFrame:
    """Count rows, and what ``rejected`` gives per row, while ``df`` is read for something else."""
    if counts is None:
        return df
    return df.observe(counts, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(rejected), F.lit(0)).alias("rejects"))


def instruct_to_dialog(
    df: DataFrame,
    source: str,
    instruction: str = "instruction",
    context: str = "context",
    response: str = "response",
    keep: Sequence[str] = (),
    counts: Observation | None = None,
) -> DataFrame:
    """Question and answer rows; a context that is present and not empty follows the question.

    A missing context column means no context.  Rows without an instruction are rejected:
    ``instruct_rejects`` lists them, and ``counts`` has their number after the first run of the result.
    """
    question = F.col(instruction)
    if context in df.columns:
        extra = F.when(F.col(context) != "", F.concat(F.lit(" "), F.col(context))).otherwise("")
        question = F.concat(question, extra)
    dialog = F.array(message("user", question), message("assistant", F.col(response)))
    lacking = F.col(instruction).isNull()
    return counted(df, counts, lacking.cast("long")).where(~lacking).select(
        *keep, dialog.cast(DIALOG_TYPE).alias("dialog"), F.lit(source).alias("source")
    )


def instruct_rejects(df: DataFrame, instruction: str = "instruction") -> DataFrame:
    return df.where(F.col(instruction).isNull())


def transcript_to_dialog(
    df: DataFrame,
    source: str,
    text: str = "input",
    system_prefix: str = "",
    user_prefix: str = "[|Human|]",
    assistant_prefix: str = "[|AI|]",
    keep: Sequence[str] = (),
    counts: Observation | None = None,
) -> DataFrame:
    """Transcripts with speaker markers; pieces without an answer are skipped.

    ``counts`` has the number of skipped pieces as its rejects after the first run of the result.
    """
    body = F.replace(F.col(text), F.lit(system_prefix), F.lit("")) if system_prefix else F.col(text)
    pieces = F.filter(
        F.transform(F.split(body, literal_pattern(user_prefix)), strip), lambda p: p != ""
    )
    halves = F.filter(
        F.transform(pieces, lambda p: F.split(p, literal_pattern(assistant_prefix), 2)),
        lambda h: F.size(h) == 2,
    )
    dialog = F.flatten(
        F.transform(
            halves,
            lambda h: F.array(
                message("user", strip(h[0])), message("assistant", strip(h[1]))
            ),
        )
    )
    skipped = F.coalesce(F.size(pieces) - F.size(halves), F.lit(0)).cast("long")
    rows = counted(df, counts, skipped)
    return rows.select(*keep, dialog.cast(DIALOG_TYPE).alias("dialog"), F.lit(source).alias("source"))


def concat_dialogs(inputs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all inputs, duplicates kept; ``source_ord`` holds the order of the inputs."""
    tagged = [df.withColumn("source_ord", F.lit(i)) for i, df in enumerate(inputs)]
    merged = tagged[0]
    for df in tagged[1:]:
        merged = merged.unionByName(df)
    return merged


def concat_positions(inputs: Sequence[tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """``concat_dialogs`` of inputs with their own order: ``pos`` is a row's place in the whole.

    Each input is placed by its own key, whatever its columns; a source begins where the ones before
    it end.  Every input is run once and written; positions and sizes are read from that.
    """
    written = [materialise(df, "input") for df, _ in inputs]
    base, placed = 0, []
    for df, (_, order) in zip(written, inputs, strict=True):
        placed.append(global_position(df, order).withColumn("pos", F.col("pos") + base))
        base += df.count()
    return concat_dialogs(placed)


def size_report(df: DataFrame, counts: Mapping[str, Observation] | None = None) -> DataFrame:
    """Rows per source and, with a null source, in total.

    With the ``counts`` of each source, taken while ``df`` was written, also ``rejects``.
    """
    report = df.rollup("source").agg(F.count(F.lit(1)).alias("rows"))
    if counts is None:
        return report
    rejects = {source: seen.get["rejects"] for source, seen in counts.items()}
    number = F.lit(sum(rejects.values())).cast("long")
    for source, n in rejects.items():
        number = F.when(F.col("source") == source, F.lit(n).cast("long")).otherwise(number)
    return report.withColumn("rejects", number)


def turns_to_dialog(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One dialog row per conversation from a table with one row per turn.

    The conversation is the row, so its turns must fit in one.
    """
    ordered = F.array_sort(F.collect_list(F.struct(turn, role, text)))
    return (
        df.groupBy(key)
        .agg(ordered.alias("_turns"))
        .select(
            key,
            F.transform("_turns", lambda t: message(t[role], t[text])).cast(DIALOG_TYPE).alias("dialog"),
        )
    )
