import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from explain import exchanges, explained
from textloom.operators import tokens as token_rows
from textloom.operators import vocab as vocabularies
from textloom.operators.tokens import (
    attention_mask,
    encode_batches,
    system_prompt_size,
    token_length,
    tokenize,
)
from textloom.operators.vocab import Specials, Vocabulary, build_vocab
from textloom.sources.scratch import materialise_bucketed

TEXTS = [
    "a b c a b a",
    "a <s> zeta </s> eta theta iota b",
    "",
    None,
    "unseen words only",
    " ".join(f"w{i}" for i in range(300)) + " a",
]


def plain_lex(text):
    return re.findall(r"<s>|</s>|\w+|[^\w\s]", text or "")


def plain_vocab(texts):
    counts = {}
    for text in texts:
        for token in plain_lex(text):
            if token not in ("<s>", "</s>"):
                counts[token] = counts.get(token, 0) + 1
    order = sorted(counts, key=lambda t: (-counts[t], t))
    return counts, {t: i + 3 for i, t in enumerate(order)}


def corpus(spark, texts=TEXTS):
    rows = [("train", i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "split string, pos long, text string").repartition(3)


def test_vocabulary_order_and_size(spark):
    counts, ids = plain_vocab(TEXTS)
    got = build_vocab(corpus(spark)).collect()
    assert {r.token: (r.n, r.id) for r in got} == {t: (counts[t], ids[t]) for t in ids}
    small = build_vocab(corpus(spark), size=10).collect()
    assert {r.token: r.id for r in small} == {t: i for t, i in ids.items() if i < 10}


@pytest.mark.parametrize("head", [4, 10, 100, 1 << 18])
def test_ids_with_and_without_a_tail(spark, head):
    _, ids = plain_vocab(TEXTS[:4] + TEXTS[5:])
    ids.update({"<s>": 1, "</s>": 2})
    table = build_vocab(corpus(spark, TEXTS[:4] + TEXTS[5:]))
    vocab = Vocabulary(table, head=head)
    assert (vocab.tail is None) == (head > 320)
    got = {r.pos: r.input_ids for r in tokenize(corpus(spark), vocab).collect()}
    for pos, text in enumerate(TEXTS):
        expected = None if text is None else [ids.get(t, 0) for t in plain_lex(text)]
        assert got[pos] == expected, pos


def test_frequent_tokens_outside_the_head(spark):
    # "hot" is in the tail, "gone" in no vocabulary; both fill many rows.
    table = spark.createDataFrame([("a", 3), ("hot", 4), ("rare", 5)], "token string, id int")
    vocab = Vocabulary(table, head=4)
    texts = ["a hot gone rare" if i % 10 == 0 else "hot gone hot a" for i in range(50)]
    got = {r.pos: r.input_ids for r in tokenize(corpus(spark, texts), vocab).collect()}
    ids = {"a": 3, "hot": 4, "rare": 5}
    assert got == {i: [ids.get(t, 0) for t in text.split()] for i, text in enumerate(texts)}


def test_truncation_counts_the_special_token(spark):
    vocab = Vocabulary(build_vocab(corpus(spark)))
    full = {r.pos: r.input_ids for r in tokenize(corpus(spark), vocab, add_bos=True).collect()}
    cut = tokenize(corpus(spark), vocab, add_bos=True, max_length=4)
    for r in cut.collect():
        assert r.input_ids == (full[r.pos] and full[r.pos][:4])
        assert r.input_ids is None or r.input_ids[0] == 1
    length = token_length(F.col("text"), Specials(), 4)
    plain = tokenize(corpus(spark), vocab, max_length=4)
    sizes = {r.pos: len(r.input_ids) for r in plain.where("input_ids is not null").collect()}
    got = corpus(spark).where("text is not null").select("pos", length.alias("n")).collect()
    assert {r.pos: r.n for r in got} == sizes


def test_attention_is_all_ones(spark):
    df = spark.createDataFrame([([5, 6, 7],), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(attention_mask(F.col("ids"))).collect()] == [[1, 1, 1], []]


def test_system_prompt_size(spark):
    size = system_prompt_size(F.lit("Be brief."), Specials())
    # bos; << SYS >> is five tokens, the text three, < < / SYS > > six.
    assert spark.range(1).select(size).first()[0] == 1 + 5 + 3 + 6


def test_pad_falls_back_to_eos():
    assert Specials().pad_id == Specials().eos_id == 2
    assert Specials(pad="<pad>").pad_id == 3


def test_marker_ids(spark):
    vocab = Vocabulary(build_vocab(corpus(spark, ["q [/INST] a"])))
    ids = {r.token: r.id for r in vocab.table.collect()}
    assert vocab.ids_of("[/INST]") == [ids["["], ids["/"], ids["INST"], ids["]"]]
    assert vocab.ids_of("<s>nope") == [1, 0]


def test_a_user_tokenizer_runs_per_batch(spark):
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.models.WordLevel({"[UNK]": 0, "a": 1, "b": 2}, unk_token="[UNK]")
    tokenizer = tokenizers.Tokenizer(model)
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    saved = tokenizer.to_str()

    def encode(texts):
        loaded = tokenizers.Tokenizer.from_str(saved)
        return [e.ids for e in loaded.encode_batch(texts)]

    got = encode_batches(corpus(spark, ["a b", "b x a", ""]), encode).collect()
    assert {r.pos: r.input_ids for r in got} == {0: [1, 2], 1: [2, 0, 1], 2: []}


def test_tail_ids_of_null_and_repeated_keys(spark):
    table = spark.createDataFrame([("a", 3), ("b", 4)], "token string, id int")
    rows = [(1, "a b a"), (1, "b a"), (None, "b"), (None, "a c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = tokenize(df, Vocabulary(table, head=3), keep=["doc_id"]).collect()
    assert sorted(((r.doc_id or 0), r.input_ids) for r in got) == [(0, [3, 0]), (0, [4]), (1, [3, 4, 3]), (1, [4, 3])]


def test_parts_do_not_grow_with_the_input(spark, monkeypatch):
    """The rows of a task are looked up in parts of bounded size, each next to its own rare tokens."""
    monkeypatch.setattr(vocabularies, "PIECE_BYTES", 40)
    monkeypatch.setattr(vocabularies, "PART_BYTES", 100)
    written = []

    def spy(df, *how):
        written.append(materialise_bucketed(df, *how))
        return written[-1]

    monkeypatch.setattr(token_rows, "materialise_bucketed", spy)
    texts = ["a b c", None, "d " * 80, "", "a e"] * 20
    df = corpus(spark, texts).coalesce(1)
    vocab = Vocabulary(build_vocab(df), head=4)
    plain = Vocabulary(vocab.table, head=1_000)
    got = {r.pos: r.input_ids for r in tokenize(df, vocab).collect()}
    assert got == {r.pos: r.input_ids for r in tokenize(df, plain).collect()}
    sizes = [r["n"] for r in written[0].groupBy("_part").agg(F.sum(F.size("input_ids.ids")).alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) <= 80 + 50


def test_lookups_take_pieces_of_a_batch(spark, monkeypatch):
    """Memory follows a piece, not an Arrow batch: no call sees more than a piece or one row."""
    monkeypatch.setattr(vocabularies, "PIECE_BYTES", 10)
    rows = pa.array(["a b", None, "", "c d e f g h i", "a", "b c", "x"])
    pieces = [(at, piece.to_pylist()) for at, piece, _ in vocabularies._pieces(rows)]
    assert pieces == [(0, ["a b", None, ""]), (3, ["c d e f g h i"]), (4, ["a", "b c", "x"])]
    assert not list(vocabularies._pieces(rows.slice(0, 0)))


def test_the_tail_moves_no_ids(spark):
    """Only tokens are shuffled: ids are read again where they were written."""
    vocab = Vocabulary(build_vocab(corpus(spark)), head=5)
    plan = explained(tokenize(corpus(spark), vocab))
    assert "FlatMapCoGroupsInArrow" in plan and "Bucketed: true" in plan
    assert not [x for x in exchanges(plan) if "input_ids" in x]


def test_all_special_tokens_are_single(spark):
    specials = Specials(pad="<pad>")
    vocab = Vocabulary(build_vocab(corpus(spark), specials=specials), specials)
    assert vocab.ids_of("<pad> <unk></s>") == [specials.pad_id, specials.unk_id, specials.eos_id]
