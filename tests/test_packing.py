import random

import pytest
from pyspark.sql import functions as F

from explain import exchanges, explained
from textloom.functions.text import render_prompt
from textloom.operators import packing as C
from textloom.operators.dialogs import DIALOG_TYPE, turns_to_dialog
from textloom.operators.order import global_position
from textloom.operators.split import head_percent_split
from textloom.operators.vocab import Vocabulary, build_vocab
from textloom.plans import chat


def greedy(lengths, max_length, system):
    """Row by row: ``[(rank, pack, slot)]`` for lengths sorted from long to short."""
    out, first, last, pack = [], 0, len(lengths) - 1, 0
    while first <= last:
        out.append((first, pack, 0))
        used, slot, opener = lengths[first], 0, first
        first += 1
        while last > opener and used + lengths[last] + system <= max_length:
            slot += 1
            used += lengths[last]
            out.append((last, pack, slot))
            last -= 1
        pack += 1
    return sorted(out)


def played(lengths, max_length, system):
    histogram = {}
    for n in lengths:
        histogram[n] = histogram.get(n, 0) + 1
    out = []
    for lo, hi, base, anchor, per_pack, opener in C.plan_segments(histogram.items(), max_length, system):
        for r in range(lo, hi + 1):
            d = anchor - r
            out.append((r, base - d, 0) if opener else (r, base + d // per_pack, 1 + d % per_pack))
    return sorted(out)


def test_segments_match_the_row_by_row_rule():
    rng = random.Random(1)
    for _ in range(4000):
        top = rng.choice([3, 10, 50])
        lengths = sorted((rng.randint(rng.choice([0, 1]), top) for _ in range(rng.randint(0, 40))), reverse=True)
        max_length, system = rng.randint(top, 4 * top), rng.randint(0, 5)
        assert played(lengths, max_length, system) == greedy(lengths, max_length, system)


def test_segments_stay_few():
    rng = random.Random(2)
    histogram = [(n, rng.randint(1, 100_000)) for n in range(1, 2049)]
    assert len(list(C.plan_segments(histogram, 2048, 20))) < 4 * len(histogram)


def frame(spark, lengths):
    rows = [("train", i, n) for i, n in enumerate(lengths)]
    rows += [("validation", i, n) for i, n in enumerate(lengths[:5])]
    return spark.createDataFrame(rows, "split string, pos long, length int").repartition(5)


@pytest.mark.parametrize(
    "lengths,max_length,system",
    [
        ([], 100, 5),
        ([7], 100, 5),
        ([7, 7], 100, 5),
        ([100] * 20, 100, 5),
        ([10] * 50, 100, 5),
        ([60, 50, 40, 30, 20, 10, 5], 100, 0),
        ([90, 5, 5], 100, 50),
        ([64] * 1000 + [3] * 500 + [20] * 500, 100, 4),
        ([(i * 37) % 100 + 1 for i in range(900)], 100, 4),
    ],
)
def test_packs_match_the_row_by_row_rule(spark, lengths, max_length, system):
    df = frame(spark, lengths)
    packs = C.pack_dialogs(df, max_length, system)
    for split, part in (("train", lengths), ("validation", lengths[:5])):
        order = sorted(range(len(part)), key=lambda i: (-part[i], i))
        expected = {
            order[r]: (p, s) for r, p, s in greedy([part[i] for i in order], max_length, system)
        }
        got = packs.where(F.col("split") == split).collect()
        assert {r.pos: (r.pack_id, r.slot) for r in got} == expected
        assert len(got) == len(part)
    coverage = C.pack_coverage(df, packs).collect()
    assert all(r.missing == 0 and r.repeated == 0 for r in coverage)
    assert all(r.violations == 0 for r in C.pack_violations(packs, max_length).collect())


def test_coverage_sees_lost_and_repeated_rows(spark):
    df = frame(spark, [5, 5, 5]).where("split = 'train'")
    packs = spark.createDataFrame(
        [("train", 0, 5, 0, 0), ("train", 0, 5, 1, 0), ("train", 1, 5, 1, 1)],
        "split string, pos long, length int, pack_id long, slot long",
    )
    got = C.pack_coverage(df, packs).first()
    assert (got["rows"], got["missing"], got["repeated"]) == (3, 1, 1)


def test_merged_turns_follow_the_slots(spark):
    dialogs = [("train", i, [("user", f"q{i}"), ("assistant", f"a{i}")]) for i in range(4)]
    df = spark.createDataFrame(dialogs, f"split string, pos long, dialog {DIALOG_TYPE}")
    packs = spark.createDataFrame(
        [("train", 2, 0, 0), ("train", 0, 0, 2), ("train", 3, 0, 1), ("train", 1, 1, 0)],
        "split string, pos long, pack_id long, slot long",
    )
    got = {r.pack_id: [m.content for m in r.dialog] for r in C.merge_packs(df, packs).collect()}
    assert got == {0: ["q2", "a2", "q3", "a3", "q0", "a0"], 1: ["q1", "a1"]}


def test_streams_cannot_be_packed(spark, sf_dir):
    path = f"{sf_dir}/conversations.parque[t]"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    with pytest.raises(ValueError):
        C.dialog_lengths(stream, 100)


def turn_rows():
    rows = [(1, 0, "system", "Be kind. <s>"), (1, 1, "user", "a b, c"), (1, 2, "assistant", "d")]
    rows += [(2, 0, "assistant", "x </s> y"), (2, 1, "assistant", ""), (3, 5, "user", None), (3, 6, None, "z!")]
    rows += [(4, 0, "user", "word " * 300), (5, 0, "user", "q"), (5, 0, "user", "q"), (None, 1, "user", "n")]
    return rows + [(k, t, "user" if t % 2 == 0 else "assistant", f"t{k} " * (k % 7)) for k in range(6, 40) for t in range(k % 4 + 1)]


def turn_table(spark):
    return spark.createDataFrame(turn_rows(), "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("max_length", [50, 10_000])
def test_lengths_of_turns_equal_lengths_of_dialogs(spark, max_length):
    turns = turn_table(spark)
    dialogs = turns_to_dialog(turns).withColumns({"split": F.lit("train"), "pos": F.col("conv_id")})
    whole = {r.pos: r.length for r in C.dialog_lengths(dialogs, max_length).collect()}
    assert {r.conv_id: r.length for r in C.turn_lengths(turns, max_length).collect()} == whole
    plan = explained(C.turn_lengths(turns, max_length))
    assert not [x for x in exchanges(plan) if "text" in x]


def test_samples_of_turns_equal_samples_of_dialogs(spark):
    turns = turn_table(spark).where("conv_id IS NOT NULL")
    dialogs = head_percent_split(global_position(turns_to_dialog(turns), "conv_id"), 10)
    prompts = dialogs.select(render_prompt(F.col("dialog"), "Sys.").alias("text"))
    vocab = Vocabulary(build_vocab(prompts))
    key = lambda df: sorted((r.split, r.pos, r.input_ids) for r in df.collect())
    got = chat.samples_of_turns(turns, vocab, 60, "Sys.", pct=10)
    assert key(got) == key(chat.chat_samples(dialogs, vocab, 60, "Sys."))
    assert len([x for x in exchanges(explained(got)) if "text" in x or "dialog" in x or "_turns" in x]) <= 2
