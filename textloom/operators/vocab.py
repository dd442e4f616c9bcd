"""Vocabularies: counting the tokens of a corpus, and looking ids up at scale."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.labels import list_offsets, nulls_of, runs_of, to_lists
from textloom.functions.lexer import lexed, tells_specials, word_points
from textloom.functions.text import lex, lexer_pattern
from textloom.operators.order import global_position

# The most frequent ids are broadcast; at some 30 bytes each this stays below 16 MB.
HEAD_TOKENS = 1 << 19
# Bytes of text that one lookup takes, and of a part whose rare tokens are looked up together.
PIECE_BYTES, PART_BYTES = 1 << 22, 1 << 23
# Rows of token counts that a task holds before it adds up those of one token and hands them on.
COUNT_ROWS = 1 << 20

IDS = T.ArrayType(T.IntegerType())
IDS_AND_REST = T.StructType(
    [
        T.StructField("ids", IDS),
        T.StructField("at", IDS),
        T.StructField("rest", T.ArrayType(T.StringType())),
    ]
)
# The same with ids as bytes, four each: Parquet takes an array apart value by value.
BYTES_AND_REST = T.StructType([T.StructField("ids", T.BinaryType()), *IDS_AND_REST.fields[1:]])


@dataclass(frozen=True)
class Specials:
    """Special tokens; they take the first ids, and a missing pad falls back to eos."""

    unk: str = "<unk>"
    bos: str = "<s>"
    eos: str = "</s>"
    pad: str | None = None

    @property
    def tokens(self) -> list[str]:
        return [self.unk, self.bos, self.eos] + ([self.pad] if self.pad else [])

    def id(self, token: str) -> int:
        return self.tokens.index(token)

    @property
    def unk_id(self) -> int:
        return self.id(self.unk)

    @property
    def bos_id(self) -> int:
        return self.id(self.bos)

    @property
    def eos_id(self) -> int:
        return self.id(self.eos)

    @property
    def pad_id(self) -> int:
        return self.id(self.pad) if self.pad else self.eos_id

    @property
    def pattern(self) -> str:
        return lexer_pattern(*sorted(self.tokens, key=len, reverse=True))


def count_tokens(df: DataFrame, text: str = "text", specials: Specials = Specials()) -> DataFrame:
    """``token, n`` over all texts, specials left out.

    Texts are lexed and counted piece by piece where they are; only counts leave the Python workers.
    """
    if tells_specials(specials.tokens):
        counted = _counted(word_points(df.sparkSession), specials.tokens)
        counts = df.select(F.make_valid_utf8(F.col(text)).alias("text")).mapInArrow(counted, "token string, n long")
    else:
        tokens = F.explode(lex(F.col(text), specials.pattern)).alias("token")
        counts = df.select(tokens, F.lit(1).cast("long").alias("n"))
    counts = counts.where(~F.col("token").isin(specials.tokens)).groupBy("token")
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def _counted(words, specials: list[str]):
    def added(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        counts = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")])
        yield from counts.select(["token", "n_sum"]).rename_columns(["token", "n"]).to_batches()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for _, piece, _ in _pieces(batch.column(0)):
                found = lexed(piece, words.value, specials)[1].value_counts()
                held.append(pa.table([found.field("values"), found.field("counts")], names=["token", "n"]))
                if sum(map(len, held)) >= COUNT_ROWS:
                    yield from added(held)
                    held = []
        if held:
            yield from added(held)

    return count


def build_vocab(
    df: DataFrame,
    text: str = "text",
    specials: Specials = Specials(),
    size: int | None = None,
) -> DataFrame:
    """``token, n, id``: ids by count descending, then token, after the special ids.

    ``size`` is the size of the vocabulary including the specials; None keeps every token.
    """
    counts = count_tokens(df, text, specials)
    ranked = global_position(counts, ["n", "token"], descending=["n"], name="id", unique=True)
    ranked = ranked.select("token", "n", (F.col("id") + len(specials.tokens)).cast("int").alias("id"))
    return ranked if size is None else ranked.where(F.col("id") < size)


class Vocabulary:
    """A finished vocabulary table ``token, id``: a broadcast head and, if needed, a joined tail.

    The head holds the ids below ``head``.  Ids go by frequency, so any token in the tail is
    rarer than every token of the head and the tail join has no hot key.
    """

    def __init__(self, table: DataFrame, specials: Specials = Specials(), head: int = HEAD_TOKENS):
        self.specials = specials
        self.table = table.select("token", "id")
        known = self.table.where(F.col("id") < head).toArrow()
        tokens = pa.array(specials.tokens + known["token"].to_pylist(), type=pa.string())
        ids = np.concatenate((np.arange(len(specials.tokens)), known["id"].to_numpy()))
        tail = self.table.where(F.col("id") >= head)
        self.tail = None if tail.limit(1).isEmpty() else tail
        self._head = table.sparkSession.sparkContext.broadcast((tokens, ids.astype(np.int32)))

    @classmethod
    def load(cls, spark: SparkSession, path: str, **options) -> Vocabulary:
        return cls(spark.read.parquet(path), **options)

    def lex(self, text: Column) -> Column:
        return lex(text, self.specials.pattern)

    def head_ids(self, tokens: Column) -> Column:
        """Ids of an array of tokens; what the head does not know is the unknown id."""
        return _ids(self._head, self.specials.unk_id)(_joined(tokens))

    def head_ids_and_rest(self, text: Column) -> Column:
        """``struct<ids, at, rest>`` of a text: ids, in bytes, with -1 at the places ``at`` of the tokens ``rest``.

        Texts are lexed next to the lookup if the specials let it.
        """
        specials = self.specials.tokens
        if not tells_specials(specials):
            return _ids_and_rest(self._head)(_joined(self.lex(text)))
        words = word_points(self.table.sparkSession)
        return _ids_and_rest(self._head, lambda piece: lexed(piece, words.value, specials))(F.make_valid_utf8(text))

    def parts(self, df: DataFrame, keep: Sequence[str], tokens: Column, name: str) -> DataFrame:
        """``_part``, ``keep`` and ``struct<ids, at, rest>`` with an array of ids; a part is a run of rows of one task.

        A part has ``PART_BYTES`` of text at most, or one longer row, however large the task's input is.
        """
        place, joined = F.spark_partition_id().cast("long").alias("_part"), _joined(tokens).alias("_tokens")
        rows = df.select(place, *keep, joined)
        fields = [rows.schema["_part"], *(df.schema[c] for c in keep), T.StructField(name, IDS_AND_REST)]
        return rows.mapInArrow(_parts(self._head, ["_part", *keep, name]), T.StructType(fields))

    def ids_of(self, text: str) -> list[int]:
        """Ids of one short string, such as a marker, looked up on the driver."""
        spark = self.table.sparkSession
        tokens = spark.range(1).select(self.lex(F.lit(text)).alias("t")).first()["t"]
        found = {t: i for i, t in enumerate(self.specials.tokens)}
        wanted = [t for t in set(tokens) if t not in found]
        found.update(
            (r["token"], r["id"]) for r in self.table.where(F.col("token").isin(wanted)).collect()
        )
        return [found.get(t, self.specials.unk_id) for t in tokens]


def _joined(tokens: Column) -> Column:
    """Tokens as one string: no token holds a space, and one string is cheap to hand over."""
    return F.array_join(tokens, " ")


def _split(joined: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and flat tokens of space-separated rows; empty and null rows have none."""
    lists = pc.split_pattern(joined, " ")
    flat = lists.flatten()
    _, counts = list_offsets(lists)
    # An empty row is split into one empty token.
    empty = pc.fill_null(pc.equal(pc.binary_length(joined), 0), False).to_numpy(zero_copy_only=False)
    if empty.any():
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
    return np.concatenate(([0], np.cumsum(counts - empty))), flat


def _find(flat: pa.Array, known: tuple[pa.Array, np.ndarray], missing: int) -> np.ndarray:
    tokens, ids = known
    # The distinct tokens are hashed, not the known ones, of which there are far more than in a piece.
    encoded = flat.dictionary_encode()
    at = pc.fill_null(pc.index_in(tokens, value_set=encoded.dictionary), -1).to_numpy(zero_copy_only=False)
    there = np.flatnonzero(at >= 0)[::-1]
    found = np.full(len(encoded.dictionary), missing, dtype=np.int32)
    found[at[there]] = ids[there]
    return found[encoded.indices.to_numpy(zero_copy_only=False)]


def _pieces(joined: pa.Array) -> Iterator[tuple[int, pa.Array, int]]:
    """``first row, rows, bytes``: runs of rows of at most ``PIECE_BYTES``, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(joined), 0).to_numpy(zero_copy_only=False)
    for at, stop in runs_of(sizes, PIECE_BYTES):
        yield at, joined.slice(at, stop - at), int(sizes[at:stop].sum())


def _per_piece(joined: pa.Array, look_up, kind: pa.DataType) -> pa.Array:
    """A lookup piece by piece, so that its memory does not follow the size of an Arrow batch."""
    return pa.concat_arrays([look_up(piece) for _, piece, _ in _pieces(joined)] or [pa.array([], kind)])


ARROW_IDS = pa.list_(pa.int32())


def _ids(shared, unk: int):
    def look_up(joined: pa.Array) -> pa.Array:
        offsets, flat = _split(joined)
        return to_lists(offsets, _find(flat, shared.value, unk), nulls_of(joined))

    @F.arrow_udf(IDS)
    def ids(joined: pa.Array) -> pa.Array:
        return _per_piece(joined, look_up, ARROW_IDS)

    return ids


ARROW_BYTES_AND_REST = pa.struct([("ids", pa.binary()), ("at", ARROW_IDS), ("rest", pa.list_(pa.string()))])


def to_bytes(offsets: np.ndarray, ids: np.ndarray, nulls: pa.Array | None = None) -> pa.Array:
    """``to_lists`` with each list as bytes, four an id."""
    places = pa.py_buffer((4 * offsets).astype(np.int32))
    rows = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, places, pa.py_buffer(ids.astype("<i4"))])
    return rows if nulls is None else pc.if_else(nulls, None, rows)


@F.arrow_udf(IDS)
def ids_of_bytes(rows: pa.Array) -> pa.Array:
    return to_lists(*_of_bytes(rows), nulls_of(rows))


def _of_bytes(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets per row and a copy of the flat ids; a null row has none."""
    rows = pc.fill_null(rows, b"")
    _, places, data = rows.buffers()
    bounds = np.frombuffer(places, np.int32)[rows.offset : rows.offset + len(rows) + 1].astype(np.int64)
    flat = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]].copy().view("<i4")
    return (bounds - bounds[0]) // 4, flat


def _found(joined: pa.Array, head: tuple[pa.Array, np.ndarray], split=_split, to_rows=to_lists) -> pa.Array:
    offsets, flat = split(joined)
    found = _find(flat, head, -1)
    places = np.flatnonzero(found == -1)
    row = np.searchsorted(offsets, places, side="right") - 1
    rest = np.searchsorted(places, offsets)
    return pa.StructArray.from_arrays(
        [
            to_rows(offsets, found, nulls_of(joined)),
            to_lists(rest, places - offsets[row]),
            pa.ListArray.from_arrays(pa.array(rest, type=pa.int32()), flat.take(pa.array(places))),
        ],
        names=IDS_AND_REST.names,
    )


def _ids_and_rest(shared, split=_split):
    @F.arrow_udf(BYTES_AND_REST)
    def ids_and_rest(joined: pa.Array) -> pa.Array:
        found = lambda piece: _found(piece, shared.value, split, to_bytes)
        return _per_piece(joined, found, ARROW_BYTES_AND_REST)

    return ids_and_rest


def _parts(shared, names: list[str]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = 0, 0
        for batch in batches:
            for at, piece, size in _pieces(batch.column(len(names) - 1)):
                if held and held + size > PART_BYTES:
                    part, held = part + 1, 0
                held += size
                first, *kept = (c.slice(at, len(piece)) for c in batch.columns[:-1])
                of = pa.array((first.to_numpy(zero_copy_only=False) << 32) + part, pa.int64())
                yield pa.RecordBatch.from_arrays([of, *kept, _found(piece, shared.value)], names=names)

    return number


def resolve_tail(df: DataFrame, vocab: Vocabulary, part: str, found: str) -> DataFrame:
    """Ids from a column of ``Vocabulary.parts``; ids never move, only distinct rare tokens do.

    ``df`` is a table bucketed by ``part``, which names bounded sets of rows such as written files.  The
    tokens that the head does not know are counted once per part and joined with the tail: that gives
    every part a dictionary of its own, next to which its rows are read again.  A token is at most one
    row per part in that join, however frequent it is.  What the tail does not hold either becomes the
    unknown id.
    """
    columns = [c for c in df.columns if c != part]
    dictionary = rare_tokens(df, [part], found).join(vocab.tail, "token")
    dictionary = dictionary.select(F.col(part).alias("_of"), "token", "id").groupBy("_of")
    schema = T.StructType([T.StructField(c, IDS if c == found else df.schema[c].dataType) for c in columns])
    unk = vocab.specials.unk_id

    def resolve(rows: pa.Table, known: pa.Table) -> pa.Table:
        looked_up = rows[found].combine_chunks()
        offsets, flat = patched(looked_up, known, unk)
        ids = to_lists(offsets, flat, nulls_of(looked_up.field("ids")))
        return pa.table({c: ids if c == found else rows[c] for c in columns})

    return df.groupBy(part).cogroup(dictionary).applyInArrow(resolve, schema)


def rare_tokens(df: DataFrame, part: list[str], found: str) -> DataFrame:
    """``part, token``: the distinct tokens of each part that the head does not know."""
    return df.select(*part, F.explode(f"{found}.rest").alias("token")).distinct()


def patched(found: pa.Array, known: pa.Table | None, unk: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of an array of ``struct<ids, at, rest>``, ids in bytes or arrays, rare tokens by a dictionary ``token, id``."""
    ids, at, rest = (found.field(c) for c in IDS_AND_REST.names)
    if pa.types.is_binary(ids.type):
        offsets, flat = _of_bytes(ids)
    else:
        offsets, _ = list_offsets(ids)
        flat = ids.flatten().to_numpy(zero_copy_only=False).copy()
    _, counts = list_offsets(at)
    places = np.repeat(offsets[:-1], counts) + at.flatten().to_numpy(zero_copy_only=False)
    if known is None or not len(known):
        flat[places] = unk
    else:
        entries = (known["token"].combine_chunks(), known["id"].fill_null(unk).combine_chunks().to_numpy())
        flat[places] = _find(rest.flatten(), entries, unk)
    return offsets, flat
