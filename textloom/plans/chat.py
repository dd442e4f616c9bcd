"""Chat corpora: pack conversations, render, tokenise, and mask everything but the answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import ANSWER_MARKER, render_prompt
from textloom.operators.collate import collate_causal, response_mask
from textloom.operators.order import global_position
from textloom.operators.packing import (
    dialog_lengths,
    merge_packs,
    merge_turns,
    pack_dialogs,
    turn_lengths,
)
from textloom.operators.split import head_percent_split
from textloom.operators.tokens import system_prompt_size, tokenize
from textloom.operators.vocab import Specials, Vocabulary
from textloom.sources.scratch import materialise


@dataclass(frozen=True)
class Packed:
    lengths: DataFrame
    packs: DataFrame


def system_size(df: DataFrame, system_prompt: str, specials: Specials, add_bos: bool = True) -> int:
    size = system_prompt_size(F.lit(system_prompt), specials, add_bos)
    return df.sparkSession.range(1).select(size).first()[0]


def pack_conversations(
    df: DataFrame,
    max_length: int,
    system_prompt: str,
    specials: Specials = Specials(),
    dialog: str = "dialog",
    add_bos: bool = True,
) -> Packed:
    """Pack assignment of ``split, pos, dialog`` rows; lengths are measured and written once."""
    lengths = materialise(dialog_lengths(df, max_length, specials, dialog), "lengths")
    size = system_size(df, system_prompt, specials, add_bos)
    return Packed(lengths, pack_dialogs(lengths, max_length, size))


def chat_samples(
    df: DataFrame,
    vocab: Vocabulary,
    max_length: int,
    system_prompt: str,
    dialog: str = "dialog",
    add_bos: bool = True,
) -> DataFrame:
    """``split, pos, input_ids``: one truncated training sample per pack, in pack order."""
    specials = vocab.specials
    packed = pack_conversations(df, max_length, system_prompt, specials, dialog, add_bos)
    merged = merge_packs(df, packed.packs, dialog)
    prompt = render_prompt(F.col(dialog), system_prompt, specials.bos, specials.eos)
    rendered = merged.select("split", F.col("pack_id").alias("pos"), prompt.alias("text"))
    return tokenize(rendered, vocab, max_length=max_length)


def pack_turns(
    turns: DataFrame,
    max_length: int,
    system_prompt: str,
    specials: Specials = Specials(),
    pct: float = 5,
    key: str = "conv_id",
    add_bos: bool = True,
) -> Packed:
    """Pack assignment of a table with one row per turn; conversations are split and placed by ``key``.

    Lengths and packs also have the ``key``.  No text is moved for them.
    """
    lengths = materialise(turn_lengths(turns, max_length, specials, key), "lengths")
    placed = materialise(head_percent_split(global_position(lengths, key), pct), "lengths")
    size = system_size(turns, system_prompt, specials, add_bos)
    packs = pack_dialogs(placed.select("split", "pos", "length"), max_length, size)
    named = placed.select(F.col("split").alias("_split"), F.col("pos").alias("_pos"), key)
    same = (F.col("split") == F.col("_split")) & (F.col("pos") == F.col("_pos"))
    return Packed(placed, packs.join(named, same).drop("_split", "_pos"))


def samples_of_turns(
    turns: DataFrame,
    vocab: Vocabulary,
    max_length: int,
    system_prompt: str,
    pct: float = 5,
    key: str = "conv_id",
    add_bos: bool = True,
) -> DataFrame:
    """``chat_samples`` of a table with one row per turn, which is grouped once, by packs."""
    specials = vocab.specials
    packed = pack_turns(turns, max_length, system_prompt, specials, pct, key, add_bos)
    merged = merge_turns(turns, packed.packs, key)
    prompt = render_prompt(F.col("dialog"), system_prompt, specials.bos, specials.eos)
    rendered = merged.select("split", F.col("pack_id").alias("pos"), prompt.alias("text"))
    return tokenize(rendered, vocab, max_length=max_length)


def masked_batches(
    samples: DataFrame, vocab: Vocabulary, batch_size: int, skip_mismatched: bool = False
) -> DataFrame:
    """Padded batches of samples in which only the answers carry labels."""
    specials = vocab.specials
    batches = collate_causal(samples, batch_size, specials.pad_id)
    marker = vocab.ids_of(ANSWER_MARKER)
    return response_mask(batches, marker, specials.eos_id, specials.pad_id, skip_mismatched)
