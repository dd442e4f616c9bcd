"""Streaming forms: each run takes what is available, writes it, and can be restarted.

The checkpoint folder makes a restart continue where the last run ended.  Grouping carries an open
batch from one micro-batch to the next; packing needs a total order and stays in batch.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.functions.text import render_prompt
from textloom.operators.blocks import group_texts, row_batches, token_spans
from textloom.operators.order import row_position
from textloom.operators.tokens import tokenize
from textloom.operators.vocab import Vocabulary
from textloom.sources.scratch import materialise


def stream_corpus(
    spark: SparkSession, path: str, schema, max_files: int | None = None
) -> DataFrame:
    """A Parquet folder, or a single file, as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    # A stream reads folders: a single file is its folder, less all other names.
    files = spark.read.schema(schema).parquet(path).inputFiles()
    folder, _, name = path.rpartition("/")
    if len(files) == 1 and unquote(files[0]).endswith(path):
        literal = "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in name)
        return reader.option("pathGlobFilter", literal).parquet(folder)
    return reader.parquet(path)


def run_to_parquet(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Drain what is available into a Parquet sink, exactly once per row."""
    query = (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_per_batch(
    df: DataFrame, job: Callable[[DataFrame, int], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Drain what is available through a batch job that is run on each micro-batch.

    Every micro-batch overwrites its own folder, so a replay after a failure changes nothing.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        job(rows, epoch).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    query = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_tokenize(
    df: DataFrame,
    vocab: Vocabulary,
    out: str,
    checkpoint: str,
    key: str = "doc_id",
    text: str = "text",
) -> StreamingQuery:
    """Token ids of every row, in one folder per micro-batch whatever the vocabulary's size."""
    return run_per_batch(
        df, lambda rows, _: tokenize(rows, vocab, text, keep=[key]), out, checkpoint
    )


def stream_render(
    df: DataFrame, out: str, checkpoint: str, key: str = "conv_id", system_prompt: str | None = None
) -> StreamingQuery:
    """One prompt per dialog row."""
    prompt = render_prompt(F.col("dialog"), system_prompt).alias("text")
    return run_to_parquet(df.select(key, prompt), out, checkpoint)


CARRIED = "rows long, blocks long, rest array<int>"


def stream_group_texts(
    df: DataFrame,
    vocab: Vocabulary,
    block_size: int,
    out: str,
    checkpoint: str,
    text: str = "text",
    batch_size: int | None = 1000,
) -> StreamingQuery:
    """Blocks of batches of ``batch_size`` rows, whatever the micro-batches, as the batch operator gives them.

    ``df`` is a stream of files.  Rows are numbered in the order of arrival, within a micro-batch by file
    and row, so keys may be null or repeat.  A batch that is not full stays open: the next micro-batch
    goes on with its tokens beyond the last full block, fewer than ``block_size``, and the number of its
    blocks.  That state is written per micro-batch below the checkpoint, next to what Spark keeps there:
    a replay reads the state before it and overwrites its own results.  A batch without a size stays
    open for ever.
    """
    if not block_size or block_size < 1:
        raise ValueError("block_size must be given")
    size = batch_size if batch_size and batch_size > 0 else None
    placed = df.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"), text
    )

    def blocks(rows: DataFrame, epoch: int) -> DataFrame:
        spark = rows.sparkSession
        before = None
        if epoch:
            before = spark.read.schema(CARRIED).parquet(f"{checkpoint}/open/epoch={epoch - 1}").first()
        seen, made, rest = before or (0, 0, [])
        batch_of = lambda pos: pos // size if size else 0
        numbered = row_position(rows).withColumn("pos", F.col("pos") + seen).withColumn("split", F.lit("train"))
        # A micro-batch of few files would leave most cores idle while its texts are lexed.
        spread = row_batches(numbered, size).repartition("pos")
        tokens = tokenize(spread, vocab, text, keep=["split", "batch_id", "pos"])
        if rest:
            # What the open batch has left goes first, in place of its last row.
            left = spark.createDataFrame([("train", batch_of(seen), seen - 1, rest)], tokens.schema)
            tokens = tokens.unionByName(left)
        tokens = materialise(tokens, "micro-batch")
        _carry(tokens, seen, made, f"{checkpoint}/open/epoch={epoch}")
        cut = group_texts(tokens, block_size, size)
        here = F.when(F.col("batch_id") == batch_of(seen), made).otherwise(0)
        return cut.withColumn("block_id", F.col("block_id") + here)

    def _carry(tokens: DataFrame, seen: int, made: int, path: str) -> None:
        """Write the state after a micro-batch: rows so far, and the open batch's blocks and last tokens."""
        spark = tokens.sparkSession
        last = tokens.agg(F.max("pos")).first()[0]
        rows = seen if last is None else max(seen, last + 1)
        opened = None if size and rows % size == 0 else rows // size if size else 0
        state = (rows, 0, [])
        if opened is not None:
            spans = token_spans(tokens.where(F.col("batch_id") == opened), size)
            kept = F.col("total") - F.col("total") % block_size
            begin = F.greatest(F.lit(0), kept - F.col("start"))
            piece = F.slice("input_ids", (begin + 1).cast("int"), F.size("input_ids"))
            tail = spans.where(F.col("start") + F.size("input_ids") > kept)
            # Fewer tokens than a block, and no row without one.
            pieces = sorted(tuple(r) for r in tail.select("start", piece, "total").collect())
            total = spans.agg(F.max("total")).first()[0] or 0
            same = made if opened == (seen // size if size else 0) else 0
            state = (rows, same + total // block_size, [i for _, ids, _ in pieces for i in ids])
        spark.createDataFrame([state], CARRIED).coalesce(1).write.mode("overwrite").parquet(path)

    return run_per_batch(placed, blocks, out, checkpoint)
