"""Fixed-size blocks cut from the concatenated tokens of consecutive rows.

Rows are cut where block borders fall, so only array slices are shuffled, never single tokens,
and no task ever holds more than one block of one group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.labels import to_lists
from textloom.operators.order import global_position, running_total
from textloom.operators.vocab import Vocabulary, ids_of_bytes, patched, rare_tokens, to_bytes
from textloom.sources.scratch import bucket_count, materialise, materialise_bucketed

# Rows of a run that one call makes blocks of, and of a batch that is one run whole.
RUN_ROWS, BATCH_ROWS = 256, 4096
# Batches of more rows than this get their offsets from range totals instead of one window.
WINDOW_ROWS = 1 << 16


def row_batches(
    df: DataFrame,
    batch_size: int | None = 1000,
    num_shards: int = 1,
    totals: dict[str, int] | None = None,
) -> DataFrame:
    """Add ``batch_id`` to rows with ``split, pos``.

    Batches are runs of consecutive rows and restart in each of ``num_shards`` contiguous
    shards; no batch size, or one below 1, makes each shard a single batch.  ``totals`` may give
    the rows per split; it is only used with more than one shard.
    """
    size = batch_size if batch_size and batch_size > 0 else None
    pos = F.col("pos")
    if num_shards <= 1:
        number = F.call_function("div", pos, F.lit(size)) if size else F.lit(0).cast("long")
        return df.withColumn("batch_id", number)
    if totals is None:
        totals = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    batch = F.raise_error(F.concat(F.lit("no total for split "), F.coalesce("split", F.lit("null"))))
    for split, n in totals.items():
        shards = max(min(num_shards, n), 1)
        short, longer = divmod(n, shards)
        border = longer * (short + 1)
        in_long = pos < border
        shard = F.when(in_long, F.call_function("div", pos, F.lit(short + 1))).otherwise(
            longer + F.call_function("div", pos - border, F.lit(max(short, 1)))
        )
        if size is None:
            number = shard
        else:
            start = F.when(in_long, shard * (short + 1)).otherwise(border + (shard - longer) * short)
            per_long, per_short = -(-(short + 1) // size), -(-short // size)
            base = F.when(in_long, shard * per_long).otherwise(
                longer * per_long + (shard - longer) * per_short
            )
            number = base + F.call_function("div", pos - start, F.lit(size))
        batch = F.when(F.col("split").eqNullSafe(F.lit(split)), number).otherwise(batch)
    return df.withColumn("batch_id", batch)


def token_spans(df: DataFrame, batch_size: int | None = 1000, ids: str = "input_ids") -> DataFrame:
    """Add each row's first token offset ``start`` within its batch, and the batch's ``total``.

    Batches larger than ``WINDOW_ROWS``, or unbounded ones, read ``df`` twice: hand over a
    written table then.
    """
    batch = Window.partitionBy("split", "batch_id").orderBy("pos")
    length = F.size(ids).cast("long")
    if batch_size and 0 < batch_size <= WINDOW_ROWS:
        upto = batch.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = batch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.withColumn("_length", length).select(
            *df.columns,
            (F.sum("_length").over(upto) - F.col("_length")).alias("start"),
            F.sum("_length").over(whole).alias("total"),
        )
    spans = running_total(df, "pos", length, parts=["split", "batch_id"], name="start", whole="total")
    spans = spans.toDF("_split", "_batch", "_pos", "start", "total")
    same = F.col("split").eqNullSafe(F.col("_split")) & (F.col("batch_id") == F.col("_batch")) & (
        F.col("pos") == F.col("_pos")
    )
    return df.join(spans, same).drop("_split", "_batch", "_pos")


def group_texts(
    df: DataFrame, block_size: int, batch_size: int | None = 1000, ids: str = "input_ids"
) -> DataFrame:
    """``split, batch_id, block_id, input_ids, labels``: full blocks only.

    ``df`` has ``split, pos, batch_id`` and token ids.  The rest of each batch that does not
    fill a block is dropped.
    """
    if not block_size or block_size < 1:
        raise ValueError("block_size must be given")
    spans = token_spans(df.select("split", "batch_id", "pos", ids), batch_size, ids)
    start, end = F.col("start"), F.col("start") + F.size(ids)
    kept = F.col("total") - F.col("total") % block_size
    last = F.call_function("div", F.least(end, kept) - 1, F.lit(block_size))
    cut = spans.where((start < kept) & (F.size(ids) > 0)).select(
        "split",
        "batch_id",
        "start",
        ids,
        F.explode(F.sequence(F.call_function("div", start, F.lit(block_size)), last)).alias("block_id"),
    )
    begin = F.greatest(F.col("start"), F.col("block_id") * block_size)
    stop = F.least(end, (F.col("block_id") + 1) * block_size)
    piece = F.slice(ids, (begin - F.col("start") + 1).cast("int"), (stop - begin).cast("int"))
    pieces = cut.select("split", "batch_id", "block_id", begin.alias("begin"), piece.alias("piece"))
    return _joined_pieces(pieces).withColumn("labels", F.col("input_ids"))


def _cut(ids: np.ndarray, base: int, total: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the block pieces in a stretch of a batch's tokens that begins at ``base``, and their blocks."""
    stop = min(base + len(ids), total - total % size)
    if stop <= base:
        return np.zeros(1, np.int64), np.zeros(0, np.int64)
    blocks = np.arange(base // size, (stop - 1) // size + 1)
    bounds = np.clip(np.append(blocks, blocks[-1] + 1) * size, base, stop) - base
    return bounds, blocks


RUN = ["split", "lead", "run"]
PIECES = "split string, batch_id long, block_id long, begin long, whole boolean, piece "


def text_blocks(
    df: DataFrame,
    vocab: Vocabulary,
    block_size: int,
    batch_size: int | None = 1000,
    text: str = "text",
    add_bos: bool = False,
) -> DataFrame:
    """``group_texts`` of texts: ``split, batch_id, block_id, input_ids, labels``.

    ``df`` has ``split, pos, batch_id`` and texts.  Only the texts are shuffled, once, to runs of
    consecutive rows: whole batches if these are small, else ``RUN_ROWS`` rows of a batch.  There they are
    lexed and looked up, once, and a run's ids are cut where they are.  Runs of larger batches need their
    offsets, and those of a vocabulary with a tail the ids of the rare tokens in them: then the ids are
    written, bucketed by run, and read again next to what the run's sizes and rare tokens gave.  Of such
    batches the pieces at the borders of runs, two at most each, are moved to be joined.  A null text has
    no tokens, not even a first one.
    """
    if not block_size or block_size < 1:
        raise ValueError("block_size must be given")
    small = bool(batch_size and 0 < batch_size <= BATCH_ROWS)
    if small:
        per_run = max(1, RUN_ROWS // batch_size)
        lead, run = F.call_function("div", "batch_id", F.lit(per_run)), F.lit(0).cast("long")
    else:
        lead, run = F.col("batch_id"), F.call_function("div", "pos", F.lit(RUN_ROWS))
    texts = df.select(
        "split",
        lead.alias("lead"),
        run.alias("run"),
        F.col("batch_id").cast("long").alias("batch_id"),
        F.col("pos").cast("long").alias("pos"),
        F.col(text).alias("text"),
    )
    # Lexed behind the shuffle, so a table of one input split keeps all cores busy.
    looked_up = texts.repartition(bucket_count(df.sparkSession), *RUN).select(
        *RUN, "batch_id", "pos", vocab.head_ids_and_rest(F.col("text")).alias("found")
    )
    unk, bos = vocab.specials.unk_id, vocab.specials.bos_id

    def cut(rows: pa.Table, known: pa.Table | None = None) -> pa.Table:
        rows = rows.sort_by([("batch_id", "ascending"), ("pos", "ascending")])
        found = rows["found"].combine_chunks()
        offsets, flat = patched(found, known, unk)
        if add_bos:
            given = found.field("ids").is_valid().to_numpy(zero_copy_only=False)
            flat = np.insert(flat, offsets[:-1][given], bos)
            offsets = offsets + np.concatenate(([0], np.cumsum(given)))
        base, whole = 0, None
        if not small:
            # One row has the offsets, the others a token.
            base, whole = pc.max(known["base"]).as_py(), pc.max(known["total"]).as_py()
        batch = rows["batch_id"].to_numpy()
        first = np.flatnonzero(np.append(True, batch[1:] != batch[:-1]))
        pieces, bounds, kept, at = [], [np.zeros(1, np.int64)], [], 0
        for row, stop in zip(first, np.append(first[1:], len(batch)), strict=True):
            own = flat[offsets[row] : offsets[stop]]
            edges, blocks = _cut(own, base, len(own) if small else whole, block_size)
            pieces.append((np.full(len(blocks), batch[row]), blocks, base + edges[:-1], np.diff(edges) == block_size))
            bounds.append(at + edges[1:])
            kept.append(own[: edges[-1]])
            at += edges[-1]
        columns = [pa.array(np.concatenate(c)) for c in zip(*pieces, strict=True)]
        lists = (to_lists if small else to_bytes)(np.concatenate(bounds), np.concatenate(kept))
        split = pa.array([rows["split"][0].as_py()] * len(lists), pa.string())
        return pa.table([split, *columns, lists], names=["split", "batch_id", "block_id", "begin", "whole", "piece"])

    if small and vocab.tail is None:
        cuts = looked_up.groupBy(*RUN).applyInArrow(lambda rows: cut(rows), PIECES + "array<int>")
    else:
        length = F.call_function("div", F.octet_length("found.ids"), F.lit(4)) + int(add_bos)
        length = F.coalesce(length.cast("long"), F.lit(0).cast("long")).alias("n")
        written = materialise_bucketed(looked_up.select("*", length), "ids", RUN)
        about = _about_runs(written, vocab, small).groupBy("_split", "_lead", "_run")
        cuts = written.groupBy(*RUN).cogroup(about).applyInArrow(cut, PIECES + ("array<int>" if small else "binary"))
    if small:
        blocks = cuts.select("split", "batch_id", "block_id", F.col("piece").alias("input_ids"))
        return blocks.withColumn("labels", F.col("input_ids"))
    cuts = materialise(cuts, "blocks").withColumn("piece", ids_of_bytes("piece"))
    whole = cuts.where("whole").select("split", "batch_id", "block_id", F.col("piece").alias("input_ids"))
    joined = _joined_pieces(cuts.where("NOT whole"))
    return whole.unionByName(joined).withColumn("labels", F.col("input_ids"))


def _about_runs(written: DataFrame, vocab: Vocabulary, small: bool) -> DataFrame:
    """``_split, _lead, _run, base, total, token, id``: offsets of runs of large batches, a row per rare token in a run."""
    zero = [F.lit(None).cast("long").alias(c) for c in ("base", "total")]
    if vocab.tail is not None:
        rare = rare_tokens(written, RUN, "found").join(vocab.tail, "token")
        rare = rare.select(*[F.col(c).alias(f"_{c}") for c in RUN], *zero, "token", "id")
        if small:
            return rare
    sizes = written.groupBy(*RUN).agg(F.sum("n").alias("n"))
    bases = running_total(sizes, "run", F.col("n"), parts=["split", "lead"], name="base", whole="total")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("token", "string"), ("id", "int"))]
    rows = bases.toDF("_split", "_lead", "_run", "base", "total").select("*", *none)
    if vocab.tail is None:
        return rows
    return rows.unionByName(rare)


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """Blocks from their pieces ``split, batch_id, block_id, begin, piece``."""
    blocks = pieces.groupBy("split", "batch_id", "block_id").agg(
        F.array_sort(F.collect_list(F.struct("begin", "piece"))).alias("pieces")
    )
    joined = F.flatten(F.transform("pieces", lambda p: p["piece"]))
    return blocks.select("split", "batch_id", "block_id", joined.alias("input_ids"))


def block_positions(blocks: DataFrame) -> DataFrame:
    """Add the 0-based position of each block in its split; reads the blocks twice."""
    return global_position(blocks, ["batch_id", "block_id"], parts=["split"])


def block_counts(df: DataFrame, block_size: int, length: Column) -> DataFrame:
    """``split, batch_id, tokens, dropped, kept, blocks`` from the rows' lengths alone: no ids are made."""
    return (
        df.groupBy("split", "batch_id")
        .agg(F.coalesce(F.sum(length.cast("long")), F.lit(0)).alias("tokens"))
        .withColumn("dropped", F.col("tokens") % block_size)
        .withColumn("kept", F.col("tokens") - F.col("dropped"))
        .withColumn("blocks", F.call_function("div", "kept", F.lit(block_size)))
    )


def block_remainder(df: DataFrame, block_size: int, ids: str = "input_ids") -> DataFrame:
    """Tokens kept and dropped per batch of token rows."""
    return block_counts(df, block_size, F.size(ids)).drop("blocks")
