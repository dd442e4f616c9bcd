"""The lexer of ``text.lex`` on whole Arrow arrays: a few passes over bytes in place of a match per token."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import SPACES, WORD

POINTS, SURROGATES = 0x110000, (0xD800, 0xE000)
SPACE, OTHER, LETTER, INNER = range(4)

_words: dict[str, object] = {}


def word_points(spark: SparkSession):
    """Broadcast flags per code point: what Spark's own expressions take for a part of a word, asked once."""
    app = spark.sparkContext.applicationId
    if app not in _words:
        low, high = SURROGATES
        points = spark.range(POINTS).where((F.col("id") < low) | (F.col("id") >= high))
        char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        found = points.where(char.rlike(f"^[{WORD}]$")).toArrow()["id"].to_numpy()
        flags = np.zeros(POINTS, bool)
        flags[found] = True
        _words[app] = spark.sparkContext.broadcast(flags)
    return _words[app]


def tells_specials(specials: Sequence[str]) -> bool:
    """Whether each special begins with a sign of ASCII and holds no white space: ``lexed`` needs that."""
    return all(
        s and s[0].isascii() and s[0].isprintable() and not (s[0].isalnum() or s[0] == "_" or set(s) & set(SPACES))
        for s in specials
    )


def _kinds(data: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The kind of each byte of valid UTF-8; all bytes of a letter are LETTER, those after another sign's first INNER."""
    table = np.full(256, OTHER, np.uint8)
    table[:128][words[:128]] = LETTER
    table[[ord(c) for c in SPACES]] = SPACE
    kinds = table[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead]
        more = 1 + (first >= 0xE0) + (first >= 0xF0)
        point = (first & (0x3F >> more)).astype(np.int32)
        for k in (1, 2, 3):
            has = more >= k
            point[has] = (point[has] << 6) | (data[lead[has] + k] & 0x3F)
        letter = words[point]
        kinds[lead] = np.where(letter, LETTER, OTHER)
        for k in (1, 2, 3):
            has = more >= k
            kinds[lead[has] + k] = np.where(letter[has], LETTER, INNER)
    return kinds


def _special_spans(data: np.ndarray, ends: np.ndarray, specials: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the special tokens from left to right, of those at one place the longest; none spans rows."""
    begins, stops = [], []
    for special in specials:
        at = np.flatnonzero(data[: max(len(data) - len(special) + 1, 0)] == special[0])
        for k, byte in enumerate(special[1:], 1):
            at = at[data[at + k] == byte]
        at = at[ends[np.searchsorted(ends, at, side="right")] >= at + len(special)]
        begins.append(at)
        stops.append(at + len(special))
    begin, stop = np.concatenate(begins), np.concatenate(stops)
    order = np.lexsort((-stop, begin))
    kept, free = [], 0
    for i, a, b in zip(order.tolist(), begin[order].tolist(), stop[order].tolist(), strict=True):
        if a >= free:
            kept.append(i)
            free = b
    return begin[kept], stop[kept]


def lexed(texts: pa.Array, words: np.ndarray, specials: Sequence[str]) -> tuple[np.ndarray, pa.Array]:
    """Offsets per row and flat tokens of valid UTF-8 texts; null texts have none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, places, values = texts.buffers()
    bounds = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kinds = _kinds(data, words)
    letter = kinds == LETTER
    starts = kinds == OTHER
    starts[:1] |= letter[:1]
    starts[1:] |= letter[1:] & ~letter[:-1]
    # A letter of more bytes is one run of them, and the first byte of a row is a sign's first.
    rows = bounds[:-1][bounds[:-1] < bounds[1:]]
    starts[rows] |= letter[rows]
    spans = _special_spans(data, bounds[1:], [s.encode() for s in specials]) if len(data) and specials else ([], [])
    if len(spans[0]):
        begin, stop = spans
        inside = np.zeros(len(data) + 1, np.int8)
        inside[begin + 1] += 1
        inside[stop] -= 1
        starts &= np.cumsum(inside[:-1], dtype=np.int8) == 0
        after = stop[stop < len(data)]
        starts[after] |= letter[after]
    at = np.flatnonzero(starts)
    # A token begins as many bytes into the flat ones as are no white space before it.
    space = kinds == SPACE
    flat = data[~space]
    begins = np.append(at - np.cumsum(space, dtype=np.int32)[at], len(flat)).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(at), pa.py_buffer(begins), pa.py_buffer(flat))
    return np.searchsorted(at, bounds), tokens
