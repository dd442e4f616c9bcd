"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles.

*Fingerprints.*  Every shingle of ``SIZE`` words, repeats included, is hashed with XXH64; a bit of the
fingerprint is set if it is set in more than half of the hashes.

*Tiles.*  Different fingerprints are compared by exclusive-or and bit counts, a tile of them against
another at a time.  The fingerprints of a tile ascend by their number of set bits; two that differ in at
most ``radius`` bits differ in this number by no more, so tile pairs whose numbers lie further apart
are skipped.

*Which tiles meet.*  All tiles against all would be quadratic in the corpus.  Fingerprints at most
``radius`` bits apart agree in one of ``radius + 1`` bands of bits, so only those that share a band are
laid out in tiles together: no link is lost.  A group of more than ``TILE`` fingerprints is split by
number of set bits and by hash, and its tile pairs are tasks of their own; no group is held whole.

A task gives back a spanning forest of the links it finds; ``links`` gives back all of them, each in
the first band its ends share.  Equal fingerprints are one before anything is compared.

Defined results: a null or empty text, or one of white space, has fingerprint zero and is linked like
any other; fewer words than a shingle make one shingle; words are folded in A-Z alone; rows with
repeated or null ids are rows of their own, and a component's id is its smallest one (null if it has
none); texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.components import components
from textloom.llm.words import IS_WORD, flat, pieces, word_bounds
from textloom.sources.scratch import materialise

SIZE, RADIUS, SEED, BITS = 3, 2, 42, 64
# Fingerprints of a group that one task takes, and of a tile that numpy compares with another.
TILE, INNER = 1 << 14, 512
# Groups up to this size are compared side by side, shifted against each other.
SMALL = 64
SLICE = 1 << 16

FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] = FOLDED[97:123]


# ---- fingerprints --------------------------------------------------------------------------------


def _shingle_bounds(column: pa.Array, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Folded words with one space between them, the bounds of all shingles, the first one of each text."""
    data, offsets = flat(column)
    inside = IS_WORD[data]
    starts, ends, first = word_bounds(inside, offsets)
    # The byte after a word stays as its space, unless the text is over.
    text_ends = np.repeat(offsets[1:], np.diff(first))
    spaces = ends[ends < text_ends]
    kept = inside
    kept[spaces] = True
    folded = FOLDED[data]
    folded[spaces] = 32
    place = np.cumsum(kept) - 1
    starts, ends = place[starts], place[ends - 1] + 1
    counts = np.diff(first)
    windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    into = np.concatenate(([0], np.cumsum(windows)))
    begin = np.arange(into[-1]) + np.repeat(first[:-1] - into[:-1], windows)
    last = begin + np.repeat(np.minimum(counts, size), windows) - 1
    return folded[kept].tobytes(), starts[begin], ends[last], into


def fingerprints_of(column: pa.Array, size: int = SIZE) -> np.ndarray:
    """Fingerprint of every text, as unsigned numbers."""
    blob, begin, end, into = _shingle_bounds(column, size)
    ones = np.zeros((len(column), BITS), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begin), SLICE):
        bounds = zip(begin[at : at + SLICE].tolist(), end[at : at + SLICE].tolist(), strict=True)
        hashes = np.array([digest(blob[a:b], SEED) for a, b in bounds], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # The texts that have shingles in this slice, and where each of them begins.
        row = int(np.searchsorted(into, at, side="right")) - 1
        stop = int(np.searchsorted(into, at + len(hashes), side="left"))
        cuts = np.maximum(into[row:stop], at)
        full = np.flatnonzero(np.append(cuts[1:], at + len(hashes)) > cuts)
        ones[row + full] += np.add.reduceat(bits, cuts[full] - at, axis=0, dtype=np.int64)
    most = 2 * ones > np.diff(into)[:, None]
    return np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``id, fingerprint`` of every row; the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, column in pieces(batch.column(1)):
                prints = pa.array(fingerprints_of(column, size).view(np.int64))
                ids = batch.column(0).slice(at, len(column))
                yield pa.RecordBatch.from_arrays([ids, prints], names=["id", "fingerprint"])

    rows = df.select(F.col(id).alias("id"), F.col(text).alias("_read"))
    schema = T.StructType([rows.schema["id"], T.StructField("fingerprint", T.LongType())])
    return rows.mapInArrow(run, schema)


# ---- tiles ---------------------------------------------------------------------------------------


def tile_hits(
    left: np.ndarray, right: np.ndarray | None, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked fingerprints, of ``left`` with each other or with ``right``, tile by tile."""
    alone = right is None
    right = left if alone else right
    order_a = np.argsort(np.bitwise_count(left), kind="stable")
    order_b = order_a if alone else np.argsort(np.bitwise_count(right), kind="stable")
    a, b = left[order_a], right[order_b]
    count_a = np.bitwise_count(a).astype(np.int64)
    count_b = np.bitwise_count(b).astype(np.int64)
    for x in range(0, len(a), INNER):
        low, high = count_a[x], count_a[min(x + INNER, len(a)) - 1]
        for y in range(x if alone else 0, len(b), INNER):
            if count_b[min(y + INNER, len(b)) - 1] < low - radius:
                continue
            if count_b[y] > high + radius:
                break
            apart = np.bitwise_count(a[x : x + INNER, None] ^ b[None, y : y + INNER])
            i, j = np.nonzero(apart <= radius)
            if alone and x == y:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield order_a[x + i], order_b[y + j]


def small_hits(prints: np.ndarray, unit: np.ndarray, most: int, radius: int) -> Iterator[tuple]:
    """Places of linked fingerprints of the same unit, by shifting all units against themselves."""
    for shift in range(1, most):
        near = np.bitwise_count(prints[shift:] ^ prints[:-shift]) <= radius
        near &= unit[shift:] == unit[:-shift]
        i = np.flatnonzero(near)
        if len(i):
            yield i, i + shift


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest places of the components after linking ``i`` with ``j``."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (labels[labels] != labels).any():
            labels = labels[labels]


def band_bounds(radius: int) -> list[tuple[int, int]]:
    """First bit and width of each band."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def banded(classes: DataFrame, radius: int) -> DataFrame:
    """``band, value, fingerprint``: every fingerprint under each of its bands."""
    keys = [
        F.struct(
            F.lit(k).alias("band"),
            F.shiftrightunsigned("fingerprint", first).bitwiseAND(F.lit((1 << width) - 1)).alias("value"),
        )
        for k, (first, width) in enumerate(band_bounds(radius))
    ]
    return classes.select(F.explode(F.array(*keys)).alias("key"), "fingerprint").select(
        "key.band", "key.value", "fingerprint"
    )


UNIT = ["band", "value", "a", "b"]


def units(rows: DataFrame, radius: int) -> DataFrame:
    """``band, value, a, b, side, fingerprint``: what meets in one task.

    Groups of at most ``TILE`` are one unit.  Of larger ones every pair of tiles within reach is one,
    with the first tile's fingerprints on side 0 and the second's on side 1.
    """
    zero = F.lit(0).cast("long")
    sizes = rows.groupBy("band", "value").agg(F.count(F.lit(1)).alias("_n"))
    large = materialise(sizes.where(F.col("_n") > TILE).select("band", "value"), "large")
    one_task = [zero.alias("a"), zero.alias("b"), zero.alias("side"), "fingerprint"]
    if large.isEmpty():
        return rows.select("band", "value", *one_task)
    group = ["band", "value"]
    small = rows.join(large, group, "left_anti").select("band", "value", *one_task)
    split = rows.join(large, group, "left_semi").withColumn("ones", F.bit_count("fingerprint"))
    per_count = split.groupBy(*group, "ones").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("chunks"))
    per_count = materialise(per_count, "tiles")
    number = F.col("ones") * F.lit(1 << 32) + F.col("chunk")
    chunk = F.pmod(F.xxhash64("fingerprint", F.lit(SEED)), F.col("chunks"))
    placed = split.join(per_count, [*group, "ones"]).withColumn("chunk", chunk)
    placed = placed.select(*group, number.alias("tile"), "fingerprint")
    tiles = per_count.withColumn("chunk", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    tiles = tiles.select(*group, "ones", number.alias("tile"))
    # Tiles of a group within reach: joined by the number of set bits, never all with all.
    reach = tiles.withColumn("ones", F.explode(F.array(*[F.col("ones") + d for d in range(radius + 1)])))
    reach = reach.withColumnRenamed("tile", "a")
    pairs = reach.join(tiles.withColumnRenamed("tile", "b"), [*group, "ones"])
    pairs = materialise(pairs.where(F.col("a") <= F.col("b")).select(*UNIT), "pairs")
    left = placed.withColumnRenamed("tile", "a").join(pairs, [*group, "a"])
    right = placed.withColumnRenamed("tile", "b").join(pairs.where(F.col("a") < F.col("b")), [*group, "b"])
    columns = [*UNIT, "side", "fingerprint"]
    return (
        small.unionByName(left.withColumn("side", zero).select(*columns))
        .unionByName(right.withColumn("side", zero + 1).select(*columns))
    )


Hits = Iterator[tuple[np.ndarray, np.ndarray]]


def per_unit(rows: DataFrame, solve: Callable[[np.ndarray, Hits, np.ndarray], pa.RecordBatch], schema: str, radius: int) -> DataFrame:
    """``solve(fingerprints, hits, bands)`` for runs of whole units; one unit at most is carried over."""

    def solved(keys: np.ndarray, side: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        begins = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, len(keys)))
        two = np.maximum.reduceat(side, starts) > 0
        # A unit of two tiles begins with the first one; without the second, nothing meets.
        across = keys[starts, 2] != keys[starts, 3]
        small = (sizes <= SMALL) & ~across
        if small.any():
            at = np.flatnonzero(np.repeat(small & (sizes > 1), sizes))
            unit = np.repeat(np.arange(len(starts)), sizes)[at]
            hits = small_hits(prints[at], unit, int(sizes[small].max()), radius)
            yield solve(prints[at], hits, keys[at, 0])
        for k in np.flatnonzero(~small).tolist():
            own = slice(starts[k], starts[k] + sizes[k])
            if across[k]:
                first = int((side[own] == 0).sum())
                if not two[k] or not first:
                    continue
                pairs = tile_hits(prints[own][:first], prints[own][first:], radius)
                hits = ((i, j + first) for i, j in pairs)
            else:
                hits = tile_hits(prints[own], None, radius)
            yield solve(prints[own], hits, keys[own, 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            held = columns if held is None else np.concatenate((held, columns))
            changes = np.flatnonzero((held[1:, :4] != held[:-1, :4]).any(axis=1))
            if len(changes):
                ready, held = held[: changes[-1] + 1], held[changes[-1] + 1 :]
                yield from solved(ready[:, :4], ready[:, 4], ready[:, 5].copy().view(np.uint64))
        if held is not None and len(held):
            yield from solved(held[:, :4], held[:, 4], held[:, 5].copy().view(np.uint64))

    columns = [F.col(c).cast("long").alias(c) for c in (*UNIT, "side", "fingerprint")]
    placed = rows.select(*columns).repartition(*UNIT).sortWithinPartitions(*UNIT, "side")
    return placed.mapInArrow(run, schema)


def forest(rows: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links that connect within each unit what its linked fingerprints connect."""

    def solve(prints: np.ndarray, hits: Hits, _: np.ndarray) -> pa.RecordBatch:
        labels = np.arange(len(prints))
        for i, j in hits:
            labels = merge(labels, i, j)
        moved = np.flatnonzero(labels != np.arange(len(prints)))
        ends = (prints[moved].view(np.int64), prints[labels[moved]].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(e) for e in ends], names=["a", "b"])

    return per_unit(rows, solve, "a long, b long", radius)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b, bits``: all pairs of different fingerprints at most ``radius`` bits apart, once each."""
    bounds = band_bounds(radius)

    def solve(prints: np.ndarray, hits: Hits, bands: np.ndarray) -> pa.RecordBatch:
        found = []
        for i, j in hits:
            apart = prints[i] ^ prints[j]
            first = np.ones(len(i), dtype=bool)
            for k, (at, width) in enumerate(bounds):
                same = (apart >> np.uint64(at)) & np.uint64((1 << width) - 1) == 0
                first &= ~same | (bands[i] <= k)
            found.append(np.stack((prints[i], prints[j], np.bitwise_count(apart).astype(np.uint64)), axis=1)[first])
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.uint64)
        rows = rows.view(np.int64)
        ends = (np.minimum(rows[:, 0], rows[:, 1]), np.maximum(rows[:, 0], rows[:, 1]), rows[:, 2])
        return pa.RecordBatch.from_arrays([pa.array(e) for e in ends], names=["a", "b", "bits"])

    classes = materialise(prints.select("fingerprint").distinct(), "classes")
    return per_unit(units(banded(classes, radius), radius), solve, "a long, b long, bits long", radius)


def near_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, radius: int = RADIUS
) -> DataFrame:
    """``id, fingerprint, component``: for every row its fingerprint and the smallest id linked with it."""
    prints = materialise(fingerprints(df, id, text, size), "prints")
    classes = materialise(prints.groupBy("fingerprint").agg(F.min("id").alias("first")), "classes")
    edges = materialise(forest(units(banded(classes, radius), radius), radius), "links")
    linked = materialise(components(edges), "components")
    named = classes.join(linked, F.col("fingerprint") == F.col("node"), "left")
    named = named.select("fingerprint", "first", F.coalesce("label", "fingerprint").alias("label"))
    named = materialise(named, "named")
    smallest = named.groupBy("label").agg(F.min("first").alias("component"))
    classes = materialise(named.join(smallest, "label").select("fingerprint", "component"), "classes")
    return prints.join(classes, "fingerprint").select("id", "fingerprint", "component")


def hexadecimal(fingerprint: str = "fingerprint"):
    """The fingerprint as 16 lower-case digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
