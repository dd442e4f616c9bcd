import random

import pytest
from pyspark.sql import functions as F

from explain import exchanges, explained
from textloom.operators import blocks as B
from textloom.operators.tokens import token_length, tokenize
from textloom.operators.vocab import Vocabulary, build_vocab
from textloom.plans import corpus


def plain_blocks(rows, block, batch):
    """``{(batch, block): ids}`` from lists of ids in row order."""
    out, size = {}, batch or len(rows) or 1
    for b in range(0, len(rows), size):
        flat = [t for ids in rows[b : b + size] for t in ids]
        for i in range(len(flat) // block):
            out[b // size, i] = flat[i * block : (i + 1) * block]
    return out


def token_rows(rng, n, longest):
    return [list(range(k, k + rng.randint(0, longest))) for k in rng.sample(range(10**6), n)]


def frame(spark, rows, partitions=4):
    data = [("train", i, ids) for i, ids in enumerate(rows)]
    return spark.createDataFrame(data, "split string, pos long, input_ids array<int>").repartition(partitions)


@pytest.mark.parametrize("batch", [1, 7, 50, None, 0, 100_000])
@pytest.mark.parametrize("block", [1, 8, 64])
def test_blocks_match_brute_force(spark, block, batch):
    rng = random.Random(f"{block}/{batch}")
    rows = token_rows(rng, 60, 40)
    rows[3] = list(range(500))
    df = B.row_batches(frame(spark, rows), batch)
    got = B.group_texts(df, block, batch).collect()
    assert {(r.batch_id, r.block_id): r.input_ids for r in got} == plain_blocks(rows, block, batch or None)
    assert all(r.labels == r.input_ids and len(r.input_ids) == block for r in got)


def test_batches_never_span_splits(spark):
    rows = [("train", i, [i, i]) for i in range(5)] + [("validation", i, [9]) for i in range(3)]
    df = spark.createDataFrame(rows, "split string, pos long, input_ids array<int>")
    for batch in (100, None):
        got = B.group_texts(B.row_batches(df, batch), 3, batch).collect()
        assert {(r.split, r.block_id): r.input_ids for r in got} == {
            ("train", 0): [0, 0, 1],
            ("train", 1): [1, 2, 2],
            ("train", 2): [3, 3, 4],
            ("validation", 0): [9, 9, 9],
        }


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_blocks_do_not_depend_on_partitioning(spark, partitions):
    rows = token_rows(random.Random(5), 40, 30)
    df = B.row_batches(frame(spark, rows, partitions), None)
    got = B.group_texts(df, 16, None).collect()
    assert {(r.batch_id, r.block_id): r.input_ids for r in got} == plain_blocks(rows, 16, None)


def test_remainder_adds_up(spark):
    rows = token_rows(random.Random(6), 50, 30)
    df = B.row_batches(frame(spark, rows), 10)
    report = B.block_remainder(df, 16).collect()
    blocks = B.group_texts(df, 16, 10).count()
    assert sum(r.kept for r in report) == blocks * 16
    assert sum(r.kept + r.dropped for r in report) == sum(map(len, rows))


@pytest.mark.parametrize("n", [0, 1, 2, 10, 23])
@pytest.mark.parametrize("shards", [1, 3, 7])
@pytest.mark.parametrize("size", [None, 1, 4])
def test_sharded_batches(spark, n, shards, size):
    k = min(shards, n) or 1
    expected, number = {}, 0
    for i in range(k):
        lo = i * (n // k) + min(i, n % k)
        hi = (i + 1) * (n // k) + min(i + 1, n % k)
        for start in range(lo, hi, size or max(hi - lo, 1)):
            for pos in range(start, min(start + (size or hi - lo), hi)):
                expected[pos] = number
            number += 1
    df = spark.createDataFrame([("train", i) for i in range(n)], "split string, pos long")
    assert {r.pos: r.batch_id for r in B.row_batches(df, size, shards).collect()} == expected


def test_block_size_is_required(spark):
    with pytest.raises(ValueError):
        B.group_texts(B.row_batches(frame(spark, [[1]])), None)


def test_block_positions(spark):
    rows = token_rows(random.Random(8), 40, 30)
    blocks = B.group_texts(B.row_batches(frame(spark, rows), 5), 8, 5)
    got = B.block_positions(blocks).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(len(got)))
    assert [(r.batch_id, r.block_id) for r in got] == sorted((r.batch_id, r.block_id) for r in got)


def test_blocks_need_one_shuffle(spark, capsys):
    df = B.row_batches(frame(spark, [[1, 2], [3]]), 2)
    B.group_texts(df, 2, 2).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning(split") == 1
    assert "SinglePartition" not in plan


def text_rows(rng, n, longest, words=60):
    return [" ".join(f"w{rng.randrange(words)}" for _ in range(rng.randrange(longest))) for _ in range(n)]


def text_frame(spark, texts, split="train"):
    rows = [(split, i, t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "split string, pos long, text string, joined string, lead int").repartition(4)


@pytest.mark.parametrize("head, batch", [(10, 1), (10, 7), (10, 64), (10, None), (1 << 18, 7), (1 << 18, 300)])
def test_blocks_of_texts_equal_blocks_of_ids(spark, monkeypatch, batch, head):
    """Runs shorter than a batch, of whole batches, and with rare tokens only."""
    monkeypatch.setattr(B, "RUN_ROWS", 20)
    monkeypatch.setattr(B, "BATCH_ROWS", 30)
    rng = random.Random(f"{head}/{batch}")
    texts = text_rows(rng, 150, 30)
    texts[3], texts[4], texts[5] = " ".join(f"w{i}" for i in range(400)), "", None
    vocab = Vocabulary(build_vocab(text_frame(spark, texts[:120])), head=head)
    for bos in (False, True):
        rows = B.row_batches(text_frame(spark, texts), batch)
        got = B.text_blocks(rows, vocab, 16, batch, add_bos=bos).collect()
        ids = tokenize(text_frame(spark, texts), vocab, keep=["pos"], add_bos=bos).collect()
        ids = [r.input_ids or [] for r in sorted(ids, key=lambda r: r.pos)]
        assert {(r.batch_id, r.block_id): r.input_ids for r in got} == plain_blocks(ids, 16, batch)
        assert len(got) == len(plain_blocks(ids, 16, batch)) and all(r.labels == r.input_ids for r in got)


def test_blocks_of_texts_keep_splits_apart(spark, monkeypatch):
    monkeypatch.setattr(B, "RUN_ROWS", 4)
    monkeypatch.setattr(B, "BATCH_ROWS", 4)
    texts = text_rows(random.Random(2), 30, 20)
    both = text_frame(spark, texts).unionByName(text_frame(spark, texts[:9], None))
    vocab = Vocabulary(build_vocab(both), head=5)
    for batch in (3, None):
        got = B.text_blocks(B.row_batches(both, batch), vocab, 8, batch).collect()
        one = B.text_blocks(B.row_batches(text_frame(spark, texts), batch), vocab, 8, batch).collect()
        two = B.text_blocks(B.row_batches(text_frame(spark, texts[:9]), batch), vocab, 8, batch).collect()
        key = lambda rows: sorted((r.batch_id, r.block_id, r.input_ids) for r in rows)
        assert key(r for r in got if r.split == "train") == key(one)
        assert key(r for r in got if r.split is None) == key(two)
    assert B.text_blocks(B.row_batches(both.limit(0), None), vocab, 8, None).count() == 0


def test_texts_are_shuffled_once_and_ids_never(spark):
    df = B.row_batches(text_frame(spark, text_rows(random.Random(3), 40, 10)), 10)
    vocab = Vocabulary(build_vocab(df), head=5)
    plan = explained(B.text_blocks(df, vocab, 8, 10))
    # Texts to their runs, the distinct rare tokens and the tail to each other, the dictionaries to the runs.
    assert "FlatMapCoGroupsInArrow" in plan
    assert not [x for x in exchanges(plan) if "input_ids" in x or "piece" in x]


def test_first_blocks_only_touch_their_batches(spark):
    texts = text_rows(random.Random(4), 200, 30)
    rows = B.row_batches(text_frame(spark, texts), 10)
    vocab = Vocabulary(build_vocab(rows))
    whole = B.block_positions(B.text_blocks(rows, vocab, 16, 10)).collect()
    for cap in (0, 1, 37, 10_000, None):
        got = corpus.head_blocks(rows, vocab, 16, {"train": cap}, 10).collect()
        expected = [(r.pos, r.batch_id, r.block_id, r.input_ids) for r in whole if cap is None or r.pos < cap]
        assert sorted((r.pos, r.batch_id, r.block_id, r.input_ids) for r in got) == sorted(expected)


def test_block_counts_need_no_ids(spark):
    texts = text_rows(random.Random(6), 50, 30)
    rows = B.row_batches(text_frame(spark, texts), 7)
    vocab = Vocabulary(build_vocab(rows))
    counts = B.block_counts(rows, 16, token_length(F.col("text"), vocab.specials))
    assert "Arrow" not in explained(counts)
    made = B.text_blocks(rows, vocab, 16, 7).groupBy("batch_id").count().collect()
    assert {r.batch_id: r.blocks for r in counts.collect() if r.blocks} == {r.batch_id: r["count"] for r in made}


def test_a_split_without_a_total_is_refused(spark):
    df = text_frame(spark, ["a"] * 4)
    with pytest.raises(Exception, match="no total for split"):
        B.row_batches(df, 2, 2, {"validation": 3}).collect()
