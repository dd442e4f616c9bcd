"""Corpus metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import human_size, lex
from textloom.operators.vocab import Specials
from textloom.sources.scratch import materialise


def perplexity(mean_loss: Column) -> Column:
    """``exp`` of a mean loss; an overflow gives infinity."""
    return F.exp(mean_loss)


def perplexity_by(scored: DataFrame, group: str, loss: str = "nll", weight: str = "n") -> DataFrame:
    """Perplexity per group of a table of scored tokens; ``weight`` counts equal rows."""
    mean = F.sum(F.col(loss) * F.col(weight)) / F.sum(weight)
    return scored.groupBy(group).agg(
        F.sum(weight).alias("tokens"), perplexity(mean).alias("perplexity")
    )


def unigram_losses(
    df: DataFrame, group: str, text: str = "text", specials: Specials = Specials()
) -> DataFrame:
    """``group, token, n, nll``: add-one unigram losses, one row per group and distinct token.

    Tokens are counted before anything is shuffled by token, so a frequent one costs one row
    per task and group; groups are few, such as languages.  The counts are written once and hold
    far fewer rows than the corpus has tokens.
    """
    counts = (
        df.select(group, F.explode(lex(F.col(text), specials.pattern)).alias("token"))
        .groupBy(group, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    token = Window.partitionBy("token")
    counted = materialise(
        counts.withColumns(
            {
                "all": F.sum("n").over(token),
                "first": F.row_number().over(token.orderBy(group)) == 1,
            }
        ),
        "unigrams",
    )
    tokens, types = counted.agg(F.sum("n"), F.count_if("first")).first()
    share = (F.col("all") + 1) / F.lit(float((tokens or 0) + types))
    return counted.select(group, "token", "n", (-F.log(share)).alias("nll"))


def sample_counts(
    df: DataFrame, caps: dict[str, int | None], number: str | None = None
) -> DataFrame:
    """``split, rows, samples``: rows per split and how many of them a cap leaves.

    With a column ``number``, each row of ``df`` stands for so many rows, such as the blocks that a batch will give, see
    ``block_counts``: none of them need be made.
    """
    cap = F.lit(None).cast("long")
    for split, n in caps.items():
        cap = F.when(F.col("split") == split, F.lit(n).cast("long")).otherwise(cap)
    return (
        df.groupBy("split")
        .agg(F.sum(F.lit(1) if number is None else number).cast("long").alias("rows"))
        .where(F.col("rows") > 0)
        .withColumn("samples", F.least("rows", F.coalesce(cap, F.col("rows"))))
    )


def corpus_size(df: DataFrame, group: str = "source", text: str = "text") -> DataFrame:
    """Text volume per group, in bytes and as a readable size."""
    return (
        df.groupBy(group)
        .agg(F.sum(F.octet_length(text).cast("long")).alias("bytes"))
        .withColumn("size", human_size(F.col("bytes")))
    )


def split_summary(df: DataFrame, ids: str = "input_ids", length: Column | None = None) -> DataFrame:
    """Rows and tokens per split; a ``length`` stands in for ids that are not made yet."""
    length = F.size(ids) if length is None else length
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(length.cast("long")).alias("tokens")
    )
