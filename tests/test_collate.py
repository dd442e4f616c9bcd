import random

import numpy as np
import pytest
from pyspark.sql import Observation

from explain import exchanges, explained
from textloom.functions import labels
from textloom.operators import collate as L

MARKER, EOS, IGNORE = [7, 8, 9], 2, -100


def plain_collate(rows, pad):
    longest = max(map(len, rows))
    ids = [r + [pad] * (longest - len(r)) for r in rows]
    attention = [[1] * len(r) + [0] * (longest - len(r)) for r in rows]
    return ids, attention, [[IGNORE if v == pad else v for v in r] for r in ids]


def plain_restore(labels, attention, pad):
    if pad != EOS:
        return labels, attention
    kept = [i for i, v in enumerate(labels) if v != IGNORE]
    if not kept:
        return labels, attention
    back = [v == IGNORE and i <= kept[-1] + 1 for i, v in enumerate(labels)]
    return [EOS if b else v for v, b in zip(labels, back)], [
        1 if b else a for a, b in zip(attention, back)
    ]


def plain_mask(labels, marker):
    k = len(marker)
    starts = [i + k for i in range(len(labels) - k + 1) if labels[i : i + k] == marker]
    ends = [i + 1 for i, v in enumerate(labels) if v == EOS]
    keep = set()
    for a, b in zip(starts, ends):
        keep.update(range(a, b))
    return [v if i in keep else IGNORE for i, v in enumerate(labels)], len(starts) == len(ends)


def random_row(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        out += rng.choice([MARKER, [EOS], [rng.randint(3, 9)], [1, 5], MARKER + [5, 5, EOS]])
    return out


HAND = [
    [EOS, EOS, EOS],
    [5, 5],
    MARKER + [5, EOS, EOS, EOS],
    MARKER + [5, 5],
    [5, EOS] + MARKER + [5, EOS],
    MARKER + MARKER + [EOS],
    MARKER + [EOS] + MARKER,
    [EOS, EOS] + MARKER + [6] + MARKER + [6, EOS],
    MARKER[:2],
    [],
]


@pytest.mark.parametrize("pad", [EOS, 0])
@pytest.mark.parametrize("marker", [MARKER, [7]])
def test_masks_match_brute_force(spark, pad, marker):
    rng = random.Random(f"{pad}/{marker}")
    rows = HAND + [random_row(rng) for _ in range(400)]
    df = spark.createDataFrame(
        [("train", i, r) for i, r in enumerate(rows)], "split string, pos long, input_ids array<int>"
    ).repartition(3)
    batch = 4
    collated = L.collate_causal(df, batch, pad)
    restored = {r.pos: r for r in L.restore_eos(collated, EOS, pad).collect()}
    masked = {r.pos: r for r in L.response_mask(collated, marker, EOS, pad).collect()}
    plain = {r.pos: r for r in collated.collect()}
    kept = {r.pos: r for r in L.response_mask(collated, marker, EOS, pad, True).collect()}
    failed = {}
    for b in range(0, len(rows), batch):
        for i, (ids, att, labels) in enumerate(zip(*plain_collate(rows[b : b + batch], pad)), start=b):
            assert (plain[i].input_ids, plain[i].attention_mask, plain[i].labels) == (ids, att, labels)
            labels, att = plain_restore(labels, att, pad)
            assert (restored[i].labels, restored[i].attention_mask) == (labels, att), rows[i]
            answer, well_formed = plain_mask(labels, marker)
            assert masked[i].labels == answer, rows[i]
            assert masked[i].attention_mask == att
            assert masked[i].well_formed == well_formed == (i in kept)
            if well_formed:
                assert kept[i].labels == answer
            failed[b // batch] = failed.get(b // batch, 0) + (not well_formed)
    counts = L.mismatch_counts(L.response_mask(collated, marker, EOS, pad)).collect()
    assert {r.batch_no: r.failed for r in counts} == failed


def test_masks_take_pieces_of_a_batch(spark, monkeypatch):
    """Memory follows a piece, not an Arrow batch: pieces end between rows and lose none."""
    monkeypatch.setattr(labels, "PIECE_IDS", 12)
    assert labels.runs_of(np.array([3, 0, 9, 30, 1, 1]), 12) == [(0, 3), (3, 4), (4, 6)]
    assert labels.runs_of(np.array([], dtype=int), 12) == []
    rng = random.Random(5)
    rows = HAND + [random_row(rng) for _ in range(60)]
    df = spark.createDataFrame(
        [("train", i, r) for i, r in enumerate(rows)], "split string, pos long, input_ids array<int>"
    ).coalesce(1)
    masked = {r.pos: r for r in L.response_mask(L.collate_causal(df, 1, 0), MARKER, EOS, 0).collect()}
    for i, row in enumerate(rows):
        kept, attention, plain = (x[0] for x in plain_collate([row], 0))
        answer, well_formed = plain_mask(plain_restore(plain, attention, 0)[0], MARKER)
        assert (masked[i].input_ids, masked[i].labels, masked[i].well_formed) == (kept, answer, well_formed)


def test_a_marker_is_needed(spark):
    df = spark.createDataFrame([("train", 0, [1])], "split string, pos long, input_ids array<int>")
    with pytest.raises(ValueError):
        L.response_mask(L.collate_causal(df, 1, 0), [], EOS, 0)


def test_dropping_rows_masks_only_once(spark, capsys):
    df = spark.createDataFrame([("train", 0, [1])], "split string, pos long, input_ids array<int>")
    L.response_mask(L.collate_causal(df, 1, 0), MARKER, EOS, 0, True).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_mismatches_are_counted_in_the_same_pass(spark):
    rows = [("train", 0, [7, 8, 9, 5, EOS]), ("train", 1, [7, 8, 9, 5]), ("train", 2, [5, EOS]), ("train", 3, [1])]
    df = spark.createDataFrame(rows, "split string, pos long, input_ids array<int>").repartition(2)
    counts = Observation()
    masked = L.response_mask(L.collate_causal(df, 2, 0), MARKER, EOS, 0, skip_mismatched=True, counts=counts)
    assert {r.pos for r in masked.collect()} == {0, 3}
    assert counts.get == {"rows": 4, "failed": 2}


def test_collate_needs_no_window(spark):
    df = spark.createDataFrame([("train", 0, [1])], "split string, pos long, input_ids array<int>")
    plan = explained(L.collate_causal(df, 8, 0))
    assert "Window" not in plan and len(exchanges(plan)) == 1
