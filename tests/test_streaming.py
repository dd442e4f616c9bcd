import os
import random

import pytest
from pyspark.sql import functions as F

from explain import exchanges, explained
from textloom.operators.blocks import group_texts, row_batches
from textloom.operators.tokens import tokenize
from textloom.operators.vocab import Vocabulary, build_vocab
from textloom.sources.scratch import materialise
from textloom.streaming import jobs


@pytest.fixture(scope="module")
def corpus(spark, sf_dir, tmp_path_factory):
    """Documents in three files that are read in key order."""
    path = str(tmp_path_factory.mktemp("stream") / "docs")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    for part in range(3):
        docs.where(F.expr(f"doc_id div 20 = {part}")).coalesce(1).write.mode("append").parquet(path)
    return path, docs


@pytest.mark.parametrize("head", [50, 1 << 18])
def test_stream_tokens_equal_batch_tokens(spark, corpus, tmp_path, head):
    path, docs = corpus
    vocab = Vocabulary(build_vocab(docs), head=head)
    stream = lambda: jobs.stream_corpus(spark, path, docs.schema, max_files=1)
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    jobs.stream_tokenize(stream(), vocab, out, state)
    # A second run starts from the checkpoint and adds nothing.
    jobs.stream_tokenize(stream(), vocab, out, state)
    got = {r.doc_id: r.input_ids for r in spark.read.parquet(out).collect()}
    rows = spark.read.parquet(out).count()
    batch = {r.doc_id: r.input_ids for r in tokenize(docs, vocab, keep=["doc_id"]).collect()}
    assert got == batch and rows == len(batch)


def test_stream_blocks_equal_batch_blocks_per_file(spark, corpus, tmp_path):
    path, docs = corpus
    vocab = Vocabulary(build_vocab(docs))
    out = f"{tmp_path}/out"
    stream = jobs.stream_corpus(spark, path, docs.schema, max_files=1)
    jobs.stream_group_texts(stream, vocab, 64, out, f"{tmp_path}/state", batch_size=20)
    placed = docs.withColumns({"split": F.lit("train"), "pos": F.col("doc_id")})
    tokens = tokenize(row_batches(placed, 20), vocab, keep=["split", "batch_id", "pos"])
    batch = group_texts(tokens, 64, 20)
    key = lambda df: sorted((r.batch_id, r.block_id, r.input_ids) for r in df.collect())
    assert key(spark.read.parquet(out)) == key(batch)


def test_stream_render(spark, sf_dir, tmp_path):
    from textloom.functions.text import render_prompt
    from textloom.operators.dialogs import turns_to_dialog

    dialogs = turns_to_dialog(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    dialogs.write.parquet(f"{tmp_path}/dialogs")
    stream = jobs.stream_corpus(spark, f"{tmp_path}/dialogs", dialogs.schema)
    jobs.stream_render(stream, f"{tmp_path}/out", f"{tmp_path}/state", system_prompt="Be brief.")
    got = {r.conv_id: r.text for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    prompt = render_prompt(F.col("dialog"), "Be brief.").alias("text")
    assert got == {r.conv_id: r.text for r in dialogs.select("conv_id", prompt).collect()}


def test_a_grown_vocabulary_keeps_all_rows(spark, corpus, tmp_path):
    """The layout does not depend on the vocabulary, and a trailing slash is no part of the path."""
    path, docs = corpus
    first, source = docs.where("doc_id < 20"), f"{tmp_path}/in"
    first.coalesce(1).write.parquet(source)
    table = build_vocab(docs)
    for head, rows in ((1 << 18, 20), (50, 60)):
        stream = jobs.stream_corpus(spark, source + "/", docs.schema)
        jobs.stream_tokenize(stream, Vocabulary(table, head=head), f"{tmp_path}/out", f"{tmp_path}/state")
        assert spark.read.parquet(f"{tmp_path}/out").count() == rows
        docs.where("doc_id >= 20").coalesce(1).write.mode("append").parquet(source)


def arrive(spark, rows, path):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    df.write.mode("append").parquet(path)


def all_blocks(df):
    return sorted((r.batch_id, r.block_id, r.input_ids) for r in df.collect())


@pytest.mark.parametrize("batch_size", [7, 25, None])
def test_open_batches_are_carried_over_micro_batches(spark, tmp_path, batch_size):
    """Repeated and null ids, files of one row or none that count, and restarts lose nothing."""
    rng = random.Random(batch_size or 0)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(30))) for _ in range(60)]
    texts[5], texts[6] = None, ""
    rows = [(None if i % 9 == 0 else i // 2, t) for i, t in enumerate(texts)]
    vocab = Vocabulary(build_vocab(spark.createDataFrame(rows, "doc_id long, text string")), head=20)
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    at = 0
    for run in ((10, 1), (4, 21), (24,)):
        for n in run:
            arrive(spark, rows[at : at + n], source)
            at += n
        stream = jobs.stream_corpus(spark, source, spark.read.parquet(source).schema, max_files=1)
        jobs.stream_group_texts(stream, vocab, 16, out, state, batch_size=batch_size)
    placed = spark.createDataFrame([("train", i, t) for i, t in enumerate(texts)], "split string, pos long, text string")
    tokens = tokenize(row_batches(placed, batch_size), vocab, keep=["split", "batch_id", "pos"])
    assert all_blocks(spark.read.parquet(out)) == all_blocks(group_texts(tokens, 16, batch_size))


def test_a_micro_batch_of_one_file_is_spread(spark, tmp_path, monkeypatch):
    """Texts are lexed on all cores, however few files they come in."""
    plans = []

    def spy(df, label):
        plans.append(explained(df))
        return materialise(df, label)

    monkeypatch.setattr(jobs, "materialise", spy)
    arrive(spark, [(i, f"a b w{i}") for i in range(30)], f"{tmp_path}/in")
    stream = jobs.stream_corpus(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    vocab = Vocabulary(build_vocab(spark.read.parquet(f"{tmp_path}/in")))
    jobs.stream_group_texts(stream, vocab, 4, f"{tmp_path}/out", f"{tmp_path}/state", batch_size=10)
    assert [x for x in exchanges(plans[0]) if "text#" in x and "pos#" in x]


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    """The last commit is taken back, as after a failure between writing and committing."""
    rows = [(i, " ".join(f"w{(i * k) % 13}" for k in range(20))) for i in range(30)]
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    for lot in range(3):
        arrive(spark, rows[lot * 10 : lot * 10 + 10], source)
    schema = spark.read.parquet(source).schema
    vocab = Vocabulary(build_vocab(spark.read.parquet(source)))
    run = lambda: jobs.stream_group_texts(
        jobs.stream_corpus(spark, source, schema, max_files=1), vocab, 8, out, state, batch_size=25
    )
    run()
    before = all_blocks(spark.read.parquet(out))
    for name in ("2", ".2.crc"):
        os.remove(f"{state}/commits/{name}")
    run()
    assert all_blocks(spark.read.parquet(out)) == before and before


def test_a_single_file_is_a_stream(spark, tmp_path):
    rows = [(i, "a b") for i in range(3)]
    arrive(spark, rows, f"{tmp_path}/in")
    name = next(f for f in os.listdir(f"{tmp_path}/in") if f.endswith(".parquet"))
    for path in (f"{tmp_path}/in/{name}", f"{tmp_path}/in/"):
        out = f"{tmp_path}/out{path.endswith('/')}"
        stream = jobs.stream_corpus(spark, path, spark.read.parquet(path).schema)
        jobs.run_to_parquet(stream, out, f"{out}-state")
        assert spark.read.parquet(out).count() == 3
