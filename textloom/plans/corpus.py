"""Plain-text corpora: split, tokenise, cut into blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.blocks import WINDOW_ROWS, block_counts, row_batches, text_blocks
from textloom.operators.order import global_position, running_total
from textloom.operators.split import head_percent_split, head_samples, with_validation
from textloom.operators.tokens import token_length, tokenize
from textloom.operators.vocab import Vocabulary
from textloom.sources.scratch import materialise


def split_corpus(
    df: DataFrame, key: str = "doc_id", pct: float = 5, use_presplit: bool = True
) -> DataFrame:
    """Rows with ``split`` and ``pos``, in key order; a given split column is respected."""
    if "split" in df.columns:
        placed = global_position(df, key, parts=["split"])
        return with_validation(placed, pct, use_presplit)
    return head_percent_split(global_position(df, key), pct)


def token_batches(
    df: DataFrame,
    vocab: Vocabulary,
    text: str = "text",
    batch_size: int | None = 1000,
    num_shards: int = 1,
    add_bos: bool = False,
) -> DataFrame:
    """``split, batch_id, pos, input_ids`` of a split corpus."""
    batched = row_batches(df, batch_size, num_shards)
    tokens = tokenize(
        batched, vocab, text, keep=["split", "batch_id", "pos"], add_bos=add_bos
    )
    # Large batches are read twice for their offsets; tokenise only once.
    if not batch_size or not 0 < batch_size <= WINDOW_ROWS:
        tokens = materialise(tokens, "tokens")
    return tokens


def prepare_corpus(
    df: DataFrame,
    vocab: Vocabulary,
    block_size: int,
    key: str = "doc_id",
    text: str = "text",
    pct: float = 5,
    use_presplit: bool = True,
    batch_size: int | None = 1000,
    num_shards: int = 1,
    add_bos: bool = False,
) -> DataFrame:
    """Blocks of a corpus as it was read: ``split, batch_id, block_id, input_ids, labels``."""
    batched = row_batches(split_corpus(df, key, pct, use_presplit), batch_size, num_shards)
    return text_blocks(batched, vocab, block_size, batch_size, text, add_bos)


def head_blocks(
    df: DataFrame,
    vocab: Vocabulary,
    block_size: int,
    caps: dict[str, int | None],
    batch_size: int | None = 1000,
    text: str = "text",
    add_bos: bool = False,
) -> DataFrame:
    """The first ``caps[split]`` blocks of each named split, with their position ``pos`` in it.

    ``df`` has ``split, pos, batch_id`` and texts.  Token counts tell how many blocks each batch gives,
    and their running total where its first one stands, so only the texts of batches that are wanted
    are looked up and cut: the work follows the caps.
    """
    length = token_length(F.col(text), vocab.specials) + int(add_bos)
    counts = block_counts(df, block_size, length).select("split", "batch_id", "blocks")
    placed = running_total(materialise(counts, "counts"), "batch_id", F.col("blocks"), ["split"], name="first")
    placed = placed.withColumnRenamed("first", "pos")
    wanted = materialise(head_samples(placed, caps), "wanted").toDF("_split", "_batch", "first")
    same = F.col("split").eqNullSafe(F.col("_split")) & (F.col("batch_id") == F.col("_batch"))
    rows = df.join(wanted, same, "left_semi")
    blocks = text_blocks(rows, vocab, block_size, batch_size, text, add_bos)
    blocks = blocks.join(wanted, same).withColumn("pos", F.col("first") + F.col("block_id"))
    return head_samples(blocks.drop("_split", "_batch", "first"), caps)
