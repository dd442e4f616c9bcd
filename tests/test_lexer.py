import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from explain import explained
from textloom.functions import lexer as X
from textloom.functions.text import lex
from textloom.operators import blocks as B
from textloom.operators import vocab as V

SIGNS = ["<s>", "</s>", "<unk>", "<", ">", "/", "s", "ab", "é", "ß9", "中", "\U0001d518", "😀", "́", "½", "_", "7"]
SIGNS += [" ", "\n", "\x0b", "\x85", "\xa0", "　", "", ".", "#", "٣", "Ⅷ", "<s", "unk>"]


def lexed(spark, texts, specials):
    offsets, flat = X.lexed(pa.array(texts, pa.string()), X.word_points(spark).value, specials)
    flat = flat.to_pylist()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


@pytest.mark.parametrize("specials", [["<unk>", "<s>", "</s>"], ["<s>", "<s", "#.", "<s><"], [".", "[é"]])
def test_bytes_are_lexed_like_texts(spark, specials):
    rng = random.Random(str(specials))
    texts = ["".join(rng.choices(SIGNS, k=rng.randrange(30))) for _ in range(2000)] + ["", None, "a", "a", " ", "<s>"]
    pattern = V.lexer_pattern(*sorted(specials, key=len, reverse=True))
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", lex(F.col("t"), pattern).alias("w"))
    expected = {r.i: r.w or [] for r in frame.collect()}
    assert lexed(spark, texts, specials) == [expected[i] for i in range(len(texts))]
    assert lexed(spark, texts[5:9], specials) == [expected[i] for i in range(5, 9)]
    part = pa.array(texts, pa.string()).slice(7, 50)
    offsets, flat = X.lexed(part, X.word_points(spark).value, specials)
    assert flat.to_pylist() == [w for i in range(7, 57) for w in expected[i]] and len(offsets) == 51


def test_every_code_point_is_lexed_alike(spark):
    points = [chr(i) for i in range(X.POINTS) if not 0xD800 <= i < 0xE000]
    texts = ["a" + "b".join(points[i : i + 4096]) for i in range(0, len(points), 4096)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    expected = {r.i: r.w for r in frame.select("i", lex(F.col("t"), V.Specials().pattern).alias("w")).collect()}
    assert lexed(spark, texts, V.Specials().tokens) == [expected[i] for i in range(len(texts))]


@pytest.mark.parametrize("pad", [None, "PAD", "[ pad ]"])
def test_counts_equal_those_of_exploded_tokens(spark, monkeypatch, pad):
    """Counts are added up in several steps, and specials that begin like words or hold spaces still count as one."""
    monkeypatch.setattr(V, "PIECE_BYTES", 64)
    monkeypatch.setattr(V, "COUNT_ROWS", 40)
    specials, rng = V.Specials(pad=pad), random.Random(3)
    texts = ["".join(rng.choices([*SIGNS, "PAD", "[ pad ]"], k=20)) for _ in range(300)] + ["", None]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = {}
    for row in frame.where("text IS NOT NULL").select(lex(F.col("text"), specials.pattern).alias("w")).collect():
        for token in row.w:
            plain[token] = plain.get(token, 0) + 1
    got = {r.token: r.n for r in V.count_tokens(frame, specials=specials).collect()}
    assert got == {t: n for t, n in plain.items() if t not in specials.tokens}
    assert V.count_tokens(frame.limit(0)).count() == 0


def test_no_text_is_lexed_token_by_token(spark):
    """Blocks and counts make no array of tokens in the JVM, which took most of their time."""
    rows = spark.createDataFrame([("train", i, f"a b{i}, <s>") for i in range(20)], "split string, pos long, text string")
    counts = V.build_vocab(rows)
    assert "regexp_extract_all" not in explained(V.count_tokens(rows))
    vocab = V.Vocabulary(counts)
    assert "regexp_extract_all" not in explained(B.text_blocks(B.row_batches(rows, 5), vocab, 4, 5))


def test_invalid_bytes_become_replacement_signs(spark):
    broken = spark.sql("SELECT CAST(unhex('61FF62C3') AS STRING) AS text")
    assert {r.token for r in V.count_tokens(broken).collect()} == {"a", "b", "�"}


@pytest.mark.parametrize("pad", ["PAD", "[pad]"])
def test_blocks_with_specials_of_any_kind(spark, pad):
    """Rare tokens, null texts and specials that only the pattern tells apart from words."""
    rng = random.Random(pad)
    texts = ["".join(rng.choices([*SIGNS, "PAD", "[pad]"], k=20)) for _ in range(60)] + ["", None, "a"]
    rows = spark.createDataFrame([("train", i, t) for i, t in enumerate(texts)], "split string, pos long, text string")
    vocab = V.Vocabulary(V.build_vocab(rows.limit(40), specials=V.Specials(pad=pad)), V.Specials(pad=pad), head=9)
    ids = {r.token: r.id for r in vocab.table.collect()} | {t: i for i, t in enumerate(vocab.specials.tokens)}
    lists = {r.pos: r.w or [] for r in rows.select("pos", vocab.lex(F.col("text")).alias("w")).collect()}
    flat = [ids.get(t, 0) for i in range(len(texts)) for t in lists[i]]
    for batch in (None, 100):
        got = B.text_blocks(B.row_batches(rows, batch), vocab, 8, batch).collect()
        assert {r.block_id: r.input_ids for r in got} == {i: flat[8 * i : 8 * i + 8] for i in range(len(flat) // 8)}


def test_ids_are_written_as_bytes(spark):
    """Neither the ids of runs nor the blocks of large batches are taken apart by Parquet, id by id."""
    rows = spark.createDataFrame([("train", i, f"a b{i}") for i in range(30)], "split string, pos long, text string")
    vocab = V.Vocabulary(V.build_vocab(rows), head=5)
    plan = explained(B.text_blocks(B.row_batches(rows, None), vocab, 4, None))
    assert "piece:binary" in plan and "array<int>" not in plan
    assert "ids:binary" in explained(B.text_blocks(B.row_batches(rows, 10), vocab, 4, 10))
