"""Benchmark decontamination by template canonicalisation.

Benchmark items and documents are turned into templates: words are folded, numbers, names (words with
a capital inside a sentence) and units (after a number) become typed placeholders.  Windows of
``WINDOW`` template words are hashed; an item with fewer words is one window of its own.  The windows
of the documents are hash-joined with those of the benchmark.  A match only counts if its slots are
consistent: equal slot values in the item are equal in the document, different ones different, so that
a question with new parameters is caught and a chance mix of numbers is not.  Templates with too few
literal words, such as tables of numbers, are left out on both sides.

Every window is also hashed with the folded values of all its words, whatever their kind and case, so that
verbatim and re-cased copies are found without any literals.  Such a window needs equal values only; that of
an item of less than ``MIN_VALUES`` words, or of less than ``WINDOW`` numbers and nothing else, must also
begin and end a line, as its words are found in every text.

The benchmark's windows are counted, then handed to the tasks in blocks of at most ``BLOCK`` hashes;
each block reads every document once more, so there is no limit on the benchmark.

Defined results: null and empty texts have no windows and are clean; an item without a usable window
matches nothing; equal items are reported under the smallest id; every row is judged by itself, also
rows with repeated or null ids; only ``keep`` and the text are read.
"""

from __future__ import annotations

from collections.abc import Container, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.words import STEPS, Hasher, flat, mix, pieces, signed, word_bounds

WINDOW = 13
MIN_LITERALS = 8
MIN_SHORT_LITERALS = 5
MIN_VALUES = 3
BLOCK = 1 << 20

# Units of measure and currency words.
UNITS = (
    "mm cm m km g kg mg t l ml s ms min h hz khz mhz ghz w kw kwh j kj v a c f k b kb mb gb tb "
    "inch inches foot feet yard yards mile miles ounce ounces pound pounds gallon gallons "
    "meter meters metre metres liter liters litre litres gram grams ton tons second seconds minute "
    "minutes hour hours day days week weeks month months year years percent degree degrees dollar "
    "dollars cent cents euro euros"
).split()

LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
MARKS = mix(np.arange(1, 5, dtype=np.uint64) * STEPS[40])

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[[44, 46]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[10, 13, 33, 46, 58, 63]] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 11, 12, 34, 39, 40, 41, *b"-*#>"]] = True
# Lower case of the characters of two bytes; a sigma that ends a word is one like others.
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in map(chr, range(0x800))])
_LOWER[_LOWER >= 0x800] = np.flatnonzero(_LOWER >= 0x800)
_LOWER[0x3C2] = 0x3C3


def _unit_hashes(hasher: Hasher) -> np.ndarray:
    data, offsets = flat(pa.array(UNITS))
    return np.sort(hasher.ranges(hasher.totals(data), offsets[:-1], offsets[1:]))


@dataclass
class Parsed:
    """Words of texts: hash of the placeholder or word, hash of the value, kind, and whether a line begins.

    ``first`` has the first word of each text, and the number of words.
    """

    word: np.ndarray
    value: np.ndarray
    kind: np.ndarray
    line: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Templates:
    """Template and value windows of texts."""

    def __init__(self) -> None:
        self.hasher = Hasher()
        self.units = _unit_hashes(self.hasher)

    def words(self, column: pa.Array) -> Parsed:
        data, offsets = flat(column)
        digit = _DIGIT[data]
        inside = _ALNUM[data].copy()
        # A point or comma between digits belongs to the number.
        inside[1:-1] |= _POINT[data[1:-1]] & digit[:-2] & digit[2:]
        # Bullets, dashes and quotes of U+2000 to U+207F, and the marks of U+0080 to U+00BF, are no letters.
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] & 0xFE == 0x80))
        inside[np.concatenate((mark, mark + 1, mark + 2))] = False
        mark = np.flatnonzero(data[:-1] == 0xC2)
        mark = mark[~np.isin(data[mark + 1], (0xAA, 0xB5, 0xBA))]
        inside[np.concatenate((mark, mark + 1))] = False
        # Capitals of two bytes fold like A-Z does.
        high = np.zeros(len(data), dtype=bool)
        high[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] < 0xE0))
        low = _LOWER[(data[lead] & 0x1F).astype(np.int64) << 6 | data[lead + 1] & 0x3F]
        folded = data.copy()
        folded[lead], folded[lead + 1] = 0xC0 | low >> 6, 0x80 | low & 0x3F
        starts, ends, _ = word_bounds(inside, offsets)
        # "5km" is a number and a unit: cut where letters follow the digits that begin a word.
        edge = np.flatnonzero(digit[:-1] & inside[1:] & ~digit[1:] & ~_POINT[data[1:]]) + 1
        if len(edge) and len(starts):
            owner = np.searchsorted(starts, edge, side="right") - 1
            first_edge = np.concatenate(([True], owner[1:] != owner[:-1]))
            edge, owner = edge[first_edge], owner[first_edge]
            run = np.concatenate(([0], np.cumsum(digit | _POINT[data])))
            # The digit may also end the text before.
            numeric = (run[edge] - run[starts[owner]] == edge - starts[owner]) & (edge < ends[owner])
            numeric &= edge > starts[owner]
            edge, owner = edge[numeric], owner[numeric]
            starts = np.sort(np.concatenate((starts, edge)))
            ends = np.sort(np.concatenate((ends, edge)))
        first = np.searchsorted(starts, offsets)
        value = self.hasher.ranges(self.hasher.totals(folded), starts, ends)
        kind = np.zeros(len(starts), dtype=np.int8)
        kind[digit[starts]] = NUMBER
        begins = np.zeros(len(starts), dtype=bool)
        begins[first[:-1][first[:-1] < first[1:]]] = True
        follows = np.zeros(len(starts), dtype=bool)
        follows[1:] = (kind[:-1] == NUMBER) & (starts[1:] - ends[:-1] <= 1) & ~begins[1:]
        at = np.minimum(np.searchsorted(self.units, value), len(self.units) - 1)
        kind[follows & (kind == LITERAL) & (self.units[at] == value)] = UNIT
        second = np.minimum(starts + 1, max(len(data) - 1, 0))
        capital = (_UPPER[data[starts]] | high[second] & (data[starts] == 0xC3)) & (kind == LITERAL)
        kind[capital & ~begins & ~self._opens(data, inside, starts)] = NAME
        word = np.where(kind == LITERAL, value, MARKS[kind])
        lines = np.cumsum((data == 10) | (data == 13))[starts]
        line = begins.copy()
        line[1:] |= lines[1:] != lines[:-1]
        return Parsed(word, value, kind, line, first)

    @staticmethod
    def _opens(data: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether a sentence starts at the word: blanks or bullets before it, and then a stop or line end."""
        solid = np.where(_SPACE[data] | ~inside & (data >= 128), -1, np.arange(len(data)))
        before = np.concatenate(([-1], np.maximum.accumulate(solid)))[starts] if len(data) else starts
        return (before < 0) | _STOP[data[np.maximum(before, 0)]]

    @staticmethod
    def windows(parsed: Parsed, sizes: Container[int] | None = None) -> Iterator[tuple[int, np.ndarray, ...]]:
        """``length, places, templates, places, values``: by length, the first words and hashes of the windows.

        First come the windows that are usable as templates, then those usable by their values.
        Without ``sizes``, texts of fewer than ``WINDOW`` words are one window of their own length.
        """
        word, value, kind = parsed.word, parsed.value, parsed.kind
        counts = np.diff(parsed.first)
        left = np.repeat(parsed.first[1:], counts) - np.arange(len(word))
        own = np.repeat(np.minimum(counts, WINDOW), counts)
        literals = np.concatenate(([0], np.cumsum(kind == LITERAL)))
        numbers = np.concatenate(([0], np.cumsum(kind == NUMBER)))
        ends = np.append(parsed.line[1:], True)
        template, exact = np.zeros(len(word), dtype=np.uint64), np.zeros(len(word), dtype=np.uint64)
        for length in range(1, min(WINDOW, len(word)) + 1):
            reach = len(word) - length + 1
            template[:reach] += word[length - 1 :] * STEPS[length - 1]
            exact[:reach] += value[length - 1 :] * STEPS[length - 1]
            if sizes is not None and length not in sizes:
                continue
            at = np.flatnonzero((left >= length) & (own == length) if sizes is None else left >= length)
            need = MIN_LITERALS if length >= WINDOW else MIN_SHORT_LITERALS
            usable = at[literals[at + length] - literals[at] >= need]
            if length < WINDOW:
                plain = (length < MIN_VALUES) | (numbers[at + length] - numbers[at] == length)
                at = at[~plain | parsed.line[at] & ends[at + length - 1]]
            size = np.array([length], dtype=np.uint64) * STEPS[50]
            yield length, usable, mix(template[usable] + size), at, mix(exact[at] + size + STEPS[52])

    @staticmethod
    def slots(at: np.ndarray, spans: np.ndarray, value: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Hash of which slots of each window hold equal values, whatever the values are."""
        total = np.zeros(len(at), dtype=np.uint64)
        most = int(spans.max()) if len(spans) else 0
        last = max(len(value) - 1, 0)
        for step in range(most):
            here = np.minimum(at + step, last)
            slot = (kind[here] != LITERAL) & (spans > step)
            same = np.full(len(at), step)
            for back in range(step - 1, -1, -1):
                there = at + back
                equal = slot & (kind[there] == kind[here]) & (value[there] == value[here])
                same[equal] = back
            total += np.where(slot, STEPS[step] * (same + 1).astype(np.uint64), np.uint64(0))
        return mix(total)


def benchmark_windows(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """``window, slots, length, item_id``: one row per distinct window of the benchmark.

    A window by its values has no slots.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            for at, column in pieces(batch.column(1)):
                parsed = templates.words(column)
                row = parsed.row + at
                for length, usable, window, places, values in templates.windows(parsed):
                    slots = templates.slots(usable, np.full(len(usable), length), parsed.value, parsed.kind)
                    slots = np.concatenate((slots, np.zeros(len(places), dtype=np.uint64)))
                    window = np.concatenate((window, values))
                    ids = batch.column(0).take(pa.array(row[np.concatenate((usable, places))]))
                    spans = pa.array(np.full(len(window), length), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(window)), pa.array(signed(slots)), spans, ids],
                        names=["window", "slots", "length", "item_id"],
                    )

    rows = items.select(F.col(id).cast("long").alias("item_id"), F.col(text).alias("_read"))
    return (
        rows.mapInArrow(run, "window long, slots long, length int, item_id long")
        .groupBy("window", "slots", "length")
        .agg(F.min("item_id").alias("item_id"))
    )


def decontaminate(
    df: DataFrame, windows: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep, n_hits, item_id, contaminated`` for every row of ``df``.

    ``windows`` is the table of ``benchmark_windows``, written beforehand.  ``n_hits`` counts the
    consistent templates and the windows of equal values, ``item_id`` is the smallest item that has one.
    """
    blocks = max(1, -(-windows.count() // BLOCK))
    inner = [f"_k{i}" for i in range(len(keep))]
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(keep, inner, strict=True)],
        *([] if text in keep else [F.col(text).alias("_read")]),
        F.lit(0).cast("long").alias("n_hits"),
        F.lit(None).cast("long").alias("item_id"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    for block in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else windows
        rows = rows.mapInArrow(_probe(_table(part), list(keep).index(text) if text in keep else len(keep)), schema)
    return rows.select(
        *[F.col(k).alias(c) for c, k in zip(keep, inner, strict=True)],
        "n_hits",
        "item_id",
        (F.col("n_hits") > 0).alias("contaminated"),
    )


def _table(part: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By window length: sorted template hashes, and the slots and item of each."""
    got = part.toArrow()
    columns = [got[c].to_numpy(zero_copy_only=False) for c in ("window", "slots", "length", "item_id")]
    # An item without an id still counts as a match.
    columns[3] = np.where(np.isnan(columns[3]), -1, columns[3]) if columns[3].dtype == float else columns[3]
    table = {}
    for length in np.unique(columns[2]):
        of = columns[2] == length
        window, slots = columns[0][of].view(np.uint64), columns[1][of].view(np.uint64)
        key = mix(window ^ (slots * STEPS[51]))
        order = np.argsort(key)
        table[int(length)] = (np.unique(window), key[order], columns[3][of][order].astype(np.int64))
    return table


def _probe(table: dict, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            for first, column in pieces(batch.column(place)):
                taken = batch.slice(first, len(column))
                hits = taken.column("n_hits").to_numpy(zero_copy_only=False).copy()
                items = [[] if i is None else [i] for i in taken.column("item_id").to_pylist()]
                parsed = templates.words(column)
                rows = parsed.row
                for length, usable, window, places, values in templates.windows(parsed, table):
                    known, keys, ids = table[length]
                    near = np.minimum(np.searchsorted(known, window), len(known) - 1)
                    match = np.flatnonzero(known[near] == window)
                    spans = np.full(len(match), length)
                    slots = templates.slots(usable[match], spans, parsed.value, parsed.kind)
                    key = np.concatenate((mix(window[match] ^ (slots * STEPS[51])), mix(values)))
                    row = rows[np.concatenate((usable[match], places))]
                    near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    row, near = row[keys[near] == key], near[keys[near] == key]
                    hits += np.bincount(row, minlength=len(hits))
                    for r, item in set(zip(row.tolist(), ids[near].tolist(), strict=True)):
                        items[r].append(item)
                best = [min((i for i in found if i >= 0), default=None) for found in items]
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns[:-2],
                        pa.array(hits, pa.int64()),
                        pa.array(best, pa.int64()),
                    ],
                    names=batch.schema.names,
                )

    return run
