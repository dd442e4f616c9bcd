"""Tokenising text columns: ids, truncation, special tokens and lengths."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import lex_count, system_block
from textloom.operators.vocab import Specials, Vocabulary, resolve_tail
from textloom.sources.scratch import materialise_bucketed


def tokenize(
    df: DataFrame,
    vocab: Vocabulary,
    text: str = "text",
    keep: Sequence[str] = ("split", "pos"),
    add_bos: bool = False,
    max_length: int | None = None,
    name: str = "input_ids",
) -> DataFrame:
    """``keep`` columns and the token ids; all other columns are dropped.

    Truncation counts the beginning-of-sequence token and comes before the lookup.  A vocabulary
    with a tail has the ids of its head written once, so that the texts are lexed once; the rare tokens
    of each part that is written, of bounded size, are then looked up by themselves.  ``keep`` may be null
    or repeat.
    """
    tokens = vocab.lex(F.col(text))
    if max_length is not None:
        tokens = F.slice(tokens, 1, max(max_length - int(add_bos), 0))
    if vocab.tail is None:
        out = df.select(*keep, vocab.head_ids(tokens).alias(name))
    else:
        found = vocab.parts(df, keep, tokens, name)
        out = resolve_tail(materialise_bucketed(found, "ids", ["_part"]), vocab, "_part", name)
    if add_bos:
        bos = F.array(F.lit(vocab.specials.bos_id))
        out = out.withColumn(name, F.concat(bos, F.col(name)))
    return out


def encode_batches(
    df: DataFrame,
    encode: Callable[[list[str]], list[list[int]]],
    text: str = "text",
    keep: Sequence[str] = ("split", "pos"),
    name: str = "input_ids",
) -> DataFrame:
    """Token ids from a user's own tokenizer, called once per Arrow batch of texts."""
    schema = T.StructType(
        [df.schema[c] for c in keep] + [T.StructField(name, T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(encode(batch.column(len(keep)).to_pylist()), type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], ids], names=[*keep, name]
            )

    return df.select(*keep, text).mapInArrow(run, schema)


def attention_mask(ids: Column) -> Column:
    """All ones before padding, so it is derived and never stored or shuffled."""
    return F.array_repeat(F.lit(1), F.size(ids))


def token_length(text: Column, specials: Specials, max_length: int | None = None) -> Column:
    """Number of tokens after truncation, without building the ids."""
    n = lex_count(text, specials.pattern)
    return n if max_length is None else F.least(n, F.lit(max_length))


def system_prompt_size(system_prompt: Column, specials: Specials, add_bos: bool = True) -> Column:
    """Tokens of the system block alone, default specials included."""
    return lex_count(system_block(system_prompt), specials.pattern) + int(add_bos)
