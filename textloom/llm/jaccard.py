"""Exact Jaccard self-join of word n-grams with signature trees.

A document's set are the distinct hashes of its word n-grams.  Documents with equal sets form a class,
counted before any shuffle.  The join of different sets has three steps.

1. *Routing.*  Two sets of ``x`` and ``y`` n-grams that reach the threshold ``t`` differ in at most
   ``(1 - t) / (1 + t) * (x + y)`` n-grams.  The hash space is cut into more ranges than that (their
   number follows from a band of sizes), so a linked pair agrees in whole ranges: the digests of the
   ranges are keys under which every linked pair meets.  A document with so many empty ranges that a
   partner might agree in empty ones only also gets the keys of its smallest hashes, as many as a
   linked pair must share one of.  So no link is lost, whatever the data.
2. *Trees.*  All documents that share a key with the same anchor (the smallest class of the key) are
   one group, each document once; of groups that pruning leaves, those inside another one go.  Its sets become the leaves of a signature tree, whose nodes hold the
   OR of the bitmaps below, the range of sizes and the greatest excess of n-grams over bits.  A dual
   traversal drops node pairs whose greatest possible overlap is too small.  Two rounds of trees see
   bitmaps alone, coarse and then fine ones, and drop members without any hopeful partner; a last round
   has the sets, and compares what is left exactly, unless already connected.  Groups are split into chunks of bounded size, each with
   the anchor, so that no task holds a whole group.
3. *Cross-chunk.*  In a split group, members outside its largest component meet every chunk, by
   the same traversal of two trees.  A group that hangs together, such as thousands of near copies,
   has none.

The links found span the components of the exact join: pairs that are already connected are not
compared again.  ``join_links``, and the numbers of links, compare all hopeful pairs instead: chunks of a
group meet each other, and a pair counts in the smallest of the groups that it shares.  Sets are compared by 64-bit hashes, classes by 128 bits.

Defined results: a null or empty text has no n-grams and is linked with nothing; a text of fewer words
than an n-gram has its whole sequence as one; rows with repeated ids are rows of their own, and a
component's id is the smallest id in it (null if it has none); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.components import components
from textloom.llm.words import STEPS, Hasher, mix, pieces, shingles, signed, words
from textloom.sources.scratch import materialise

# Chunks of signatures, by rows and by bytes; groups of more chunks are linked within before they are pruned.
SIGNATURE_CHUNK, MAX_SIGNATURE_CHUNK, PRUNED_CHUNKS = 8192, 2048, 8
SIGNATURE_BYTES = 1 << 23
# Node pairs of a traversal that are looked at together.
FRONTIER = 1 << 13
# Bits of a signature for each n-gram, for the first and the second round of pruning.
COARSE, FINE = 2, 8
SPARE = 2  # ranges beyond the greatest difference
# Low bits of a routing key, shuffled in one number with the owner of the key; the others name its bucket.
KEY_BITS, OWNER_MASK = 31, (1 << 32) - 1
# Keys of a task that are packed together.
PACKED_KEYS = 1 << 20
FANOUT = 8
MIN_CHUNK, MAX_CHUNK, MAX_CHUNK_GRAMS = 64, 1024, 1 << 21
MAX_BROADCAST_IDS = 1 << 20
SLICE_WORDS = 1 << 21

SECOND = STEPS[60]
PREFIX = STEPS[61]


class Threshold:
    """``num / den`` as whole numbers, and what follows from it for sets of a size."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1, self._after(1)]
        self.edges: dict[int, np.ndarray] = {}

    def _after(self, start: int) -> int:
        """Bands span twice the ratio of linked sizes, so that about half of the sets need two."""
        return start * self.den**2 // self.num**2 + 1

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(self._after(self.starts[-1]))
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def bands(self, size: int) -> Iterator[tuple[int, int]]:
        """Bands in which a set of this size meets larger ones, and their number of ranges."""
        band = self.band(size)
        while len(self.starts) < band + 3:
            self.starts.append(self._after(self.starts[-1]))
        for at in (band, band + 1):
            if at == band or size * self.den >= self.num * self.starts[at]:
                top = self.starts[at + 1] - 1
                most = 2 * top * (self.den - self.num) // (self.den + self.num)
                if most:
                    yield at, most + SPARE

    def ranges(self, count: int) -> np.ndarray:
        if count not in self.edges:
            self.edges[count] = np.array([(k << 64) // count for k in range(count)], dtype=np.uint64)
        return self.edges[count]

    def prefix(self, size: int) -> int:
        return size + (-size * self.num // self.den) + 1

    def linked(self, x: int, y: int, both: int) -> bool:
        return self.den * both >= self.num * (x + y - both)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """Routing keys of a sorted set."""
        size, out = len(grams), []
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams ^ PREFIX))))
        for band, count in self.bands(size):
            bounds = np.append(np.searchsorted(grams, self.ranges(count)), size)
            full = bounds[1:] > bounds[:-1]
            tag = np.arange(count, dtype=np.uint64) + np.uint64(band << 32)
            digest = mix(sums[bounds[1:]] - sums[bounds[:-1]] + mix(tag * STEPS[59]))
            out.append(digest[full])
            if count - int(full.sum()) >= SPARE:
                first = grams[: self.prefix(size)]
                out.append(mix(first * STEPS[58] + np.uint64(band)))
        return np.concatenate(out) if out else grams[:0]


def sets_of(column: pa.Array, hasher: Hasher, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    hashes, first = words(column, hasher)
    grams, at = shingles(hashes, first, size)
    for start, stop in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = np.sort(grams[start:stop])
        if stop - start > 1:
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        yield own


def digests(grams: np.ndarray) -> tuple[np.int64, np.int64]:
    """128 bits that tell sets apart."""
    both = np.array([grams.sum(dtype=np.uint64), mix(grams ^ SECOND).sum(dtype=np.uint64)])
    return tuple(both.view(np.int64).tolist())


def measure(df: DataFrame, size: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n, s1, s2`` of every row: the size and digest of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at, column in pieces(batch.column(1)):
                rows = [(len(g), *digests(g)) for g in sets_of(column, hasher, size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(column)),
                        *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True)),
                    ],
                    names=["id", "n", "s1", "s2"],
                )

    rows = df.select(F.col(id).alias("id"), F.col(text).alias("_read"))
    schema = T.StructType(
        [rows.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n", "s1", "s2"))]
    )
    return rows.mapInArrow(run, schema)


def key_bits(grams: int) -> int:
    """Bits of a routing key: chance meetings stay a small, constant share of all keys."""
    return min(64, max(32, int(grams).bit_length() + 14))


def owner(s1: str) -> Column:
    """The part of ``s1`` that routing carries; it may stand for several classes."""
    return F.col(s1).bitwiseAND(F.lit(OWNER_MASK))


def packed(keys: np.ndarray, owners: np.ndarray) -> pa.RecordBatch:
    """``bucket, entries``: per bucket the low bits of its keys, each with its owner in one number."""
    bucket = keys >> np.uint64(KEY_BITS)
    entries = signed((keys & np.uint64((1 << KEY_BITS) - 1)) << np.uint64(32) | owners)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    offsets = pa.array(np.append(at, len(bucket)), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(entries[order]))
    return pa.RecordBatch.from_arrays([pa.array(signed(bucket[at])), lists], names=["bucket", "entries"])


def routes(df: DataFrame, size: int, t: Threshold, bits: int = 64, text: str = "text") -> DataFrame:
    """``bucket, entries``: where each set meets its partners; equal sets once per task.

    An entry is the rest of a key and the owner of the set, so eight bytes are shuffled for a key.
    """
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, keys, owners, held = Hasher(), set(), [], [], 0
        for batch in batches:
            for _, column in pieces(batch.column(0)):
                for grams in sets_of(column, hasher, size):
                    if len(grams):
                        digest = digests(grams)
                        if digest not in seen:
                            seen.add(digest)
                            own = t.keys(grams) >> shift
                            keys.append(own)
                            owners.append(np.full(len(own), digest[0] & OWNER_MASK, dtype=np.uint64))
                            held += len(own)
                            if held >= PACKED_KEYS:
                                yield packed(np.concatenate(keys), np.concatenate(owners))
                                keys, owners, held = [], [], 0
        if held:
            yield packed(np.concatenate(keys), np.concatenate(owners))

    return df.select(F.col(text).alias("_read")).mapInArrow(run, "bucket long, entries array<long>")


def groups(routed: DataFrame) -> DataFrame:
    """``anchor, member``: owners that share a key with a smaller one, the smallest of that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, anchor = None, None
        for batch in batches:
            key, own = (c.to_numpy() for c in batch.columns)
            if not len(key):
                continue
            begins = np.concatenate(([last is None or key[0] != last], key[1:] != key[:-1]))
            heads = np.where(begins, own, 0)
            run_of = np.cumsum(begins)
            firsts = np.concatenate(([anchor if anchor is not None else 0], heads[begins]))
            anchors = firsts[run_of]
            last, anchor = key[-1], anchors[-1]
            other = anchors != own
            if other.any():
                pairs = np.unique(np.stack((anchors[other], own[other]), axis=1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["anchor", "member"]
                )

    # Keys are spread evenly, so buckets are dealt in turn.
    parts = int(routed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = routed.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int"))
    entries = placed.select("bucket", F.explode("entries").alias("entry"))
    keys = entries.select(
        F.shiftleft("bucket", KEY_BITS).bitwiseOR(F.shiftright("entry", 32)).alias("key"),
        owner("entry").alias("owner"),
    )
    return keys.sortWithinPartitions("key", "owner").mapInArrow(run, "anchor long, member long").distinct()


# ---- signature trees -----------------------------------------------------------------------------


def signature(grams: np.ndarray, per_gram: int = FINE) -> np.ndarray:
    """Bitmap of a set, of the power of two of bits that is at least ``per_gram`` times its size."""
    bits = 256
    while bits < per_gram * len(grams):
        bits *= 2
    marks = np.zeros(bits, dtype=bool)
    marks[(grams & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").view(np.uint64)


def stacked(signatures: list[np.ndarray]) -> np.ndarray:
    """Signatures as rows of one width: wider ones are folded, which keeps each bit's low digits."""
    width = min(len(s) for s in signatures)
    return np.stack([np.bitwise_or.reduce(s.reshape(-1, width), axis=0) for s in signatures])


class Tree:
    """Sets as leaves, in order of size; level 0 holds the leaves, the last level the root."""

    def __init__(self, packed: np.ndarray, sizes: np.ndarray, group: np.ndarray):
        excess = sizes - np.bitwise_count(packed).sum(axis=1, dtype=np.int64)
        self.bitmaps, self.low, self.high = [packed], [sizes], [sizes]
        self.excess, self.first_group, self.last_group = [excess], [group], [group]
        while len(self.low[-1]) > 1:
            at = np.arange(0, len(self.low[-1]), FANOUT)
            for levels, reduce in (
                (self.bitmaps, np.bitwise_or),
                (self.low, np.minimum),
                (self.high, np.maximum),
                (self.excess, np.maximum),
                (self.first_group, np.minimum),
                (self.last_group, np.maximum),
            ):
                levels.append(reduce.reduceat(levels[-1], at, axis=0))

    @property
    def height(self) -> int:
        return len(self.low) - 1


def _hopeful(a: Tree, b: Tree, la: int, lb: int, x: np.ndarray, y: np.ndarray, t: Threshold) -> np.ndarray:
    """Which node pairs may hold a linked pair of different groups."""
    low_a, low_b, high_a, high_b = a.low[la][x], b.low[lb][y], a.high[la][x], b.high[lb][y]
    keep = (high_a * t.den >= t.num * low_b) & (high_b * t.den >= t.num * low_a)
    one = (a.first_group[la][x] == a.last_group[la][x]) & (b.first_group[lb][y] == b.last_group[lb][y])
    keep &= ~(one & (a.first_group[la][x] == b.first_group[lb][y]))
    at = np.flatnonzero(keep)
    step = max(1, SLICE_WORDS // a.bitmaps[0].shape[1])
    for start in range(0, len(at), step):
        part = at[start : start + step]
        common = np.bitwise_count(a.bitmaps[la][x[part]] & b.bitmaps[lb][y[part]]).sum(axis=1, dtype=np.int64)
        most = np.minimum(high_a[part], high_b[part])
        most = np.minimum(most, common + np.minimum(a.excess[la][x[part]], b.excess[lb][y[part]]))
        keep[part] = most * (t.num + t.den) >= t.num * (low_a[part] + low_b[part])
    return keep


def _children(x: np.ndarray, y: np.ndarray, na: int, nb: int, down_a: bool, down_b: bool):
    """All pairs of the children of node pairs; a level that stays keeps its node."""
    span_a, span_b = FANOUT if down_a else 1, FANOUT if down_b else 1
    left = (x[:, None, None] * span_a + np.arange(span_a)[None, :, None]).repeat(span_b, axis=2)
    right = (y[:, None, None] * span_b + np.arange(span_b)[None, None, :]).repeat(span_a, axis=1)
    left, right = left.ravel(), right.ravel()
    inside = (left < na) & (right < nb)
    return left[inside], right[inside]


def candidates(a: Tree, b: Tree, t: Threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs that the dual traversal leaves, in blocks; of a tree with itself each pair once.

    Depth first, ``FRONTIER`` node pairs at a time, so that memory does not follow the number of pairs.
    """
    todo = [(a.height, b.height, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        la, lb, x, y = todo.pop()
        if len(x) > FRONTIER:
            todo.append((la, lb, x[FRONTIER:], y[FRONTIER:]))
            x, y = x[:FRONTIER], y[:FRONTIER]
        keep = _hopeful(a, b, la, lb, x, y, t)
        x, y = x[keep], y[keep]
        if not len(x):
            continue
        if (la, lb) == (0, 0):
            yield x, y
            continue
        down_a, down_b = la > 0 and la >= lb, lb > 0 and lb >= la
        la, lb = la - down_a, lb - down_b
        x, y = _children(x, y, len(a.low[la]), len(b.low[lb]), down_a, down_b)
        if a is b:
            once = x <= y if la else x < y
            x, y = x[once], y[once]
        todo.append((la, lb, x, y))


def hopeful_pairs(
    packed: np.ndarray, sizes: np.ndarray, group: np.ndarray, side: np.ndarray | None, t: Threshold
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of different groups that the traversal leaves, in blocks.

    Without ``side`` it is that of one tree with itself, else of the trees of side 0 and side 1.
    """
    halves = []
    for of in (0, 1) if side is not None else (None,):
        at = np.arange(len(sizes)) if of is None else np.flatnonzero(side == of)
        if not len(at):
            return
        at = at[np.argsort(sizes[at], kind="stable")]
        halves.append((at, Tree(packed[at], sizes[at], group[at])))
    (left, a), (right, b) = halves[0], halves[-1]
    for x, y in candidates(a, b, t):
        yield left[x], right[y]


def link(
    sets: list[np.ndarray], group: np.ndarray, side: np.ndarray | None, t: Threshold
) -> list[tuple[int, int]]:
    """Links that connect what the exact join connects, beyond the given groups.

    Without ``side`` all sets meet each other, else those of side 0 meet those of side 1.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    packed = stacked([signature(s) for s in sets])
    _, root = np.unique(group, return_inverse=True)
    parent = list(range(int(root.max()) + 1))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    found, root = [], root.tolist()
    pairs = hopeful_pairs(packed, sizes, group, side, t)
    for i, j in (pair for x, y in pairs for pair in zip(x.tolist(), y.tolist(), strict=True)):
        p, q = find(root[i]), find(root[j])
        if p != q:
            small, large = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            if t.linked(len(small), len(large), both):
                parent[max(p, q)] = min(p, q)
                found.append((i, j))
    return found


def as_stars(links: list[tuple[int, int]], s1: np.ndarray, s2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows and the smallest row each is connected with, the latter left out: as many edges at most."""
    ends = np.unique(np.array(links))
    order = ends[np.lexsort((s2[ends], s1[ends]))]
    place = {k: at for at, k in enumerate(order.tolist())}
    root = list(range(len(order)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in links:
        p, q = find(place[i]), find(place[j])
        root[max(p, q)] = min(p, q)
    centre = np.array([find(k) for k in range(len(order))])
    others = np.flatnonzero(centre != np.arange(len(order)))
    return order[others], order[centre[others]]


def all_links(
    sets: list[np.ndarray], group: np.ndarray, side: np.ndarray | None, t: Threshold
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A set, all it is linked with among its hopeful partners of a block, and the n-grams in common."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    packed = stacked([signature(s) for s in sets])
    _, grams = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    marks = np.zeros(len(grams), dtype=bool)
    for x, y in hopeful_pairs(packed, sizes, group, side, t):
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        at = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        for i, partners in zip(x[at].tolist(), np.split(y, at[1:]), strict=True):
            own = grams[starts[i] : starts[i + 1]]
            marks[own] = True
            if 4 * len(partners) >= len(sets):
                both = np.add.reduceat(marks[grams], starts[:-1], dtype=np.int64)[partners]
            else:
                both = np.array([np.count_nonzero(marks[grams[starts[j] : starts[j + 1]]]) for j in partners.tolist()])
            marks[own] = False
            linked = t.den * both >= t.num * (sizes[i] + sizes[partners] - both)
            if linked.any():
                yield i, partners[linked], both[linked]


UNIT = ["u1", "u2", "u3"]


def per_unit(rows: DataFrame, columns: list[str], solve, schema: str) -> DataFrame:
    """``solve`` for the rows of each unit; only one unit at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, stop in zip(starts[:-1], starts[1:], strict=True):
                name = tuple(keys[start].tolist())
                if name != last and unit:
                    if (out := solve(pa.Table.from_batches(unit))) is not None:
                        yield out
                    unit = []
                last = name
                unit.append(batch.slice(start, stop - start))
        if unit and (out := solve(pa.Table.from_batches(unit))) is not None:
            yield out

    placed = rows.select(*UNIT, *columns).repartition(*UNIT).sortWithinPartitions(*UNIT)
    return placed.mapInArrow(run, schema)


def prune_units(rows: DataFrame, t: Threshold) -> DataFrame:
    """``anchor, s1, s2, n`` of rows ``u1, u2, u3, side, grp, s1, s2, n, signature`` with a hopeful partner."""

    def solve(unit: pa.Table) -> pa.RecordBatch | None:
        side, grp, s1, s2, n = (unit[c].to_numpy() for c in ("side", "grp", "s1", "s2", "n"))
        _, first = np.unique(np.stack((side, s1, s2), axis=1), axis=0, return_index=True)
        if len(first) < 2:
            return None
        raw = unit["signature"].take(pa.array(first)).to_pylist()
        packed = stacked([np.frombuffer(r, dtype=np.uint64) for r in raw])
        two = side[first] if side.any() else None
        found = np.zeros(len(first), dtype=bool)
        for x, y in hopeful_pairs(packed, n[first], grp[first], two, t):
            found[x] = found[y] = True
        kept = first[found]
        anchor = np.full(len(kept), unit["u1"][0].as_py(), dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), *(pa.array(c[kept]) for c in (s1, s2, n))], names=["anchor", "s1", "s2", "n"]
        )

    columns = ["side", "grp", "s1", "s2", "n", "signature"]
    return per_unit(rows, columns, solve, "anchor long, s1 long, s2 long, n long").distinct()


def link_units(rows: DataFrame, t: Threshold) -> DataFrame:
    """Edges ``a, b`` within units: rows ``u1, u2, u3, side, grp, s1, s2, grams``.

    What a unit connects comes as stars around its smallest classes, not as the chains in which the links
    were found, so that the components of all units are a few steps away.
    """

    def solve(unit: pa.Table) -> pa.RecordBatch | None:
        side, grp, s1, s2 = (unit[c].to_numpy() for c in ("side", "grp", "s1", "s2"))
        _, first = np.unique(np.stack((side, s1, s2), axis=1), axis=0, return_index=True)
        if len(first) < 2:
            return None
        raw = unit["grams"].take(pa.array(first)).to_pylist()
        sets = [np.frombuffer(r, dtype=np.uint64) for r in raw]
        side, grp, s1, s2 = side[first], grp[first], s1[first], s2[first]
        links = link(sets, grp, side if side.any() else None, t)
        if not links:
            return None
        i, j = as_stars(links, s1, s2)
        ends = [
            pa.StructArray.from_arrays([pa.array(s1[k]), pa.array(s2[k])], names=["s1", "s2"])
            for k in (i, j)
        ]
        return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    node = "struct<s1: bigint, s2: bigint>"
    return per_unit(rows, ["side", "grp", "s1", "s2", "grams"], solve, f"a {node}, b {node}")


def exact_units(rows: DataFrame, t: Threshold, counted: bool) -> DataFrame:
    """All links of rows ``u1, u2, u3, side, s1, s2, rows, anchors, grams``, each in one unit only.

    Either ``s1, s2, links``, a class and the rows it is linked with in a unit, or ``a, b, both``.
    """
    node = "struct<s1: bigint, s2: bigint>"

    def solve(unit: pa.Table) -> pa.RecordBatch | None:
        side, s1, s2, weight = (unit[c].to_numpy() for c in ("side", "s1", "s2", "rows"))
        # Without rows of side 0, or of side 1 in a unit of two chunks, there are no pairs.
        across = unit["u2"][0].as_py() != unit["u3"][0].as_py()
        if len(s1) < 2 or (across and side.min() == side.max()):
            return None
        sets = [np.frombuffer(r, dtype=np.uint64) for r in unit["grams"].to_pylist()]
        here = unit["u1"][0].as_py()
        # Groups before this one that a row is in: a pair that shares one of them is met there.
        before = [frozenset(k for k in own if k < here) for own in unit["anchors"].to_pylist()]
        links, found = np.zeros(len(s1), dtype=np.int64), []
        for i, partners, both in all_links(sets, np.arange(len(s1)), side if side.any() else None, t):
            if before[i]:
                first = np.array([before[i].isdisjoint(before[j]) for j in partners.tolist()])
                partners, both = partners[first], both[first]
            if counted:
                links[i] += weight[partners].sum()
                links[partners] += weight[i]
            elif len(partners):
                found.append((np.full(len(partners), i), partners, both))
        if counted:
            some = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (s1, s2, links)], names=["s1", "s2", "links"])
        if not found:
            return None
        i, j, both = (np.concatenate(c) for c in zip(*found, strict=True))
        ends = [pa.StructArray.from_arrays([pa.array(s1[k]), pa.array(s2[k])], names=["s1", "s2"]) for k in (i, j)]
        return pa.RecordBatch.from_arrays([*ends, pa.array(both)], names=["a", "b", "both"])

    schema = "s1 long, s2 long, links long" if counted else f"a {node}, b {node}, both long"
    return per_unit(rows, ["side", "s1", "s2", "rows", "anchors", "grams"], solve, schema)


# ---- the join --------------------------------------------------------------------------------------


def broadcast_ids(ids: DataFrame, column: str) -> DataFrame:
    """Hint to broadcast integer ids if they are few enough; else they are joined by a shuffle."""
    whole = isinstance(ids.schema[column].dataType, (T.IntegerType, T.LongType))
    return F.broadcast(ids) if whole and ids.count() <= MAX_BROADCAST_IDS else ids


def _of_classes(
    df: DataFrame, wanted: DataFrame, size: int, id: str, text: str, name: str, make
) -> DataFrame:
    """``s1, s2, n`` and ``make(set)`` of the wanted classes, from the texts of their smallest ids.

    Where ids repeat, classes may come several times, and others with them: readers join by ``s1, s2``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            for _, column in pieces(batch.column(0)):
                rows = []
                for grams in sets_of(column, hasher, size):
                    digest = digests(grams)
                    if digest not in seen:
                        seen.add(digest)
                        rows.append((*digest, len(grams), make(grams).tobytes()))
                if rows:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)],
                        names=["s1", "s2", "n", name],
                    )

    # ``wanted`` is a written table with each class once, so ids only come twice where rows share them.
    ids = wanted.select(F.col("rep").alias("_rep"))
    texts = df.select(F.col(id).alias("_id"), F.col(text).alias("_read"))
    texts = texts.join(broadcast_ids(ids, "_rep"), F.col("_id").eqNullSafe(F.col("_rep")), "left_semi")
    return materialise(texts.select("_read").mapInArrow(run, f"s1 long, s2 long, n long, {name} binary"), name)


def _pruned(rows: DataFrame, signatures: DataFrame, per_gram: int, t: Threshold, chunk_rows: int) -> DataFrame:
    """``anchor, s1, s2, n``: the members of each group less those that no signature gives a partner.

    Groups are cut into chunks, and all pairs of chunks are traversed, while they are few; larger
    groups stay as they are.
    """
    zero = F.lit(0).cast("long")
    # A signature has less than twice as many bits as asked for, or 256.
    size = F.greatest(F.lit(32), F.col("n") * per_gram / 4)
    plan = rows.groupBy("anchor").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / chunk_rows), F.ceil(F.sum(size) / SIGNATURE_BYTES)
        ).alias("chunks")
    )
    placed = rows.join(materialise(plan, "chunks"), "anchor")
    few = placed.where(F.col("chunks") <= PRUNED_CHUNKS).select(
        F.col("anchor").alias("u1"), "s1", "s2", "n",
        F.pmod(F.xxhash64("s1"), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("other"),
    )
    units = few.select(
        "u1", F.least("chunk", "other").alias("u2"), F.greatest("chunk", "other").alias("u3"),
        zero.alias("side"), F.xxhash64("s1", "s2").alias("grp"), "s1", "s2", "n",
    )
    kept = prune_units(units.join(signatures.drop("n"), ["s1", "s2"]), t)
    many = placed.where(F.col("chunks") > PRUNED_CHUNKS).select("anchor", "s1", "s2", "n")
    return _uncovered(materialise(kept.unionByName(many), "pruned"))


def _uncovered(rows: DataFrame) -> DataFrame:
    """``anchor, s1, s2, n`` less the groups that lie in another one, where all their pairs meet.

    Documents that share many keys are in as many groups, most of them parts of the first.  The group
    looked at is the largest that can hold all members: of the largest groups of each, the smallest.
    Of equal groups that of the smallest anchor stays.
    """
    node = ["s1", "s2"]
    sizes = materialise(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")), "sizes")
    largest = rows.join(sizes, "anchor").groupBy(*node).agg(F.max(F.struct("m", (-F.col("anchor")).alias("last"))).alias("in"))
    cover = rows.join(largest, node).groupBy("anchor").agg(F.min("in").alias("in"), F.count(F.lit(1)).alias("m"))
    cover = cover.select("anchor", "m", (-F.col("in.last")).alias("by")).where(F.col("by") != F.col("anchor"))
    held = rows.join(materialise(cover, "covers"), "anchor").join(rows.select(F.col("anchor").alias("by"), *node), ["by", *node])
    gone = held.groupBy("anchor", "m").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") == F.col("m"))
    return materialise(rows.join(materialise(gone.select("anchor"), "covered"), "anchor", "left_anti"), "pruned")


def _hopeful_members(
    df: DataFrame, measured: DataFrame, classes: DataFrame, size: int, t: Threshold, id: str, text: str,
    chunk_rows: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """``anchor, s1, s2, n`` of the groups, and the signatures and sets, or None if nothing can be linked."""
    bits = key_bits(measured.agg(F.sum("n")).first()[0] or 0)
    stars = materialise(groups(routes(df, size, t, bits, text)), "groups")
    if stars.isEmpty():
        return None
    # Every group with its anchor, as classes; an owner may stand for several.
    own = stars.select("anchor").distinct().withColumn("owner", F.col("anchor"))
    grouped = own.unionByName(stars.select("anchor", F.col("member").alias("owner")))
    named = classes.withColumn("owner", owner("s1"))
    wanted = materialise(named.join(grouped.select("owner").distinct(), "owner"), "candidates")
    rows = grouped.join(wanted.select("owner", "s1", "s2", "n"), "owner").select("anchor", "s1", "s2", "n")
    rows = materialise(rows, "members")
    for per_gram in (COARSE, FINE):
        signatures = _of_classes(df, wanted, size, id, text, "signature", lambda g, k=per_gram: signature(g, k))
        rows = _pruned(rows, signatures, per_gram, t, chunk_rows or SIGNATURE_CHUNK)
        if rows.isEmpty():
            return None
        left = rows.select("s1", "s2").distinct()
        wanted = materialise(wanted.join(left, ["s1", "s2"], "left_semi"), "candidates")
    return rows, signatures, _of_classes(df, wanted, size, id, text, "grams", lambda g: g)


def _exact(rows: DataFrame, sets: DataFrame, classes: DataFrame, t: Threshold, counted: bool) -> DataFrame:
    """``exact_units`` of all groups: every chunk of a group meets itself and every other one."""
    zero = F.lit(0).cast("long")
    plan = rows.groupBy("anchor").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / MAX_CHUNK), F.ceil(F.sum("n") / MAX_CHUNK_GRAMS)).alias("chunks")
    )
    anchors = rows.groupBy("s1", "s2").agg(F.collect_set("anchor").alias("anchors"))
    known = classes.select("s1", "s2", "rows").join(anchors, ["s1", "s2"])
    # Rows with repeated ids give a set several times.
    known = known.join(sets.select("s1", "s2", "grams"), ["s1", "s2"]).dropDuplicates(["s1", "s2"])
    known = materialise(known, "members")
    placed = rows.join(materialise(plan, "chunks"), "anchor").select(
        F.col("anchor").alias("u1"), "s1", "s2",
        F.pmod(F.xxhash64("s1"), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("other"),
    )
    units = placed.select(
        "u1", F.least("chunk", "other").alias("u2"), F.greatest("chunk", "other").alias("u3"),
        (F.col("chunk") > F.col("other")).cast("long").alias("side"), "s1", "s2",
    )
    return exact_units(units.join(known, ["s1", "s2"]), t, counted)


def _links(rows: DataFrame, signatures: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """``node, label`` of the linked classes."""
    # Chunks of a group: by its number of members and of n-grams.
    per_chunk = F.least(F.greatest(F.col("m") / 256, F.lit(MIN_CHUNK)), F.lit(MAX_CHUNK))
    plan = (
        rows.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"))
        .select(
            "anchor",
            F.greatest(F.ceil(F.col("m") / per_chunk), F.ceil(F.col("grams") / MAX_CHUNK_GRAMS)).alias("chunks"),
        )
    )
    plan = materialise(plan, "chunks")
    rows = materialise(rows.join(plan, "anchor"), "members")
    zero = F.lit(0).cast("long")
    # The anchor goes to every chunk of its group.
    chunk = F.when(owner("s1") == F.col("anchor"), F.sequence(zero, F.col("chunks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("s1"), F.col("chunks")))
    )
    units = rows.select(
        F.col("anchor").alias("u1"), F.explode(chunk).alias("u2"), zero.alias("u3"), zero.alias("side"),
        F.xxhash64("s1", "s2").alias("grp"), "s1", "s2",
    )
    linked = materialise(components(link_units(units.join(sets, ["s1", "s2"]), t)), "components")
    split = rows.where(F.col("chunks") > 1)
    if split.isEmpty():
        return linked
    # First the signatures, then the sets of what they leave.
    apart = _labelled(split, linked)
    hopeful = prune_units(_across(apart).join(signatures, ["s1", "s2"]), t)
    apart = materialise(apart.join(materialise(hopeful, "pruned"), ["anchor", "s1", "s2"], "left_semi"), "labelled")
    if apart.isEmpty():
        return linked
    more = materialise(link_units(_across(apart).join(sets, ["s1", "s2"]), t), "links")
    if more.isEmpty():
        return linked
    joined = linked.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)
    return materialise(components(joined), "components")


def _labelled(split: DataFrame, linked: DataFrame) -> DataFrame:
    """``anchor, s1, s2, label``: the members of split groups with the component they are in."""
    rows = split.withColumn("node", F.struct("s1", "s2"))
    rows = rows.join(linked, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return materialise(rows.select("anchor", "s1", "s2", "label"), "labelled")


def _across(rows: DataFrame) -> DataFrame:
    """Units of members outside a group's largest component against all members of the group."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    parts = rows.groupBy("anchor", "label").agg(F.count(F.lit(1)).alias("m"))
    main = parts.groupBy("anchor").agg(
        F.max(F.struct("m", "label"))["label"].alias("main"),
        F.sum("m").alias("m"),
        (F.sum("m") - F.max("m")).alias("others"),
    )
    per_chunk = F.lit(MAX_SIGNATURE_CHUNK)
    main = main.where(F.col("others") > 0).select(
        "anchor", "main", F.ceil(F.col("m") / per_chunk).alias("chunks"), F.ceil(F.col("others") / per_chunk).alias("blocks")
    )
    rows = rows.join(materialise(main, "parts"), "anchor").withColumn("grp", F.xxhash64("label"))
    outside = rows.where(F.col("label") != F.col("main")).select(
        F.col("anchor").alias("u1"),
        F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("u2"),
        F.pmod(F.xxhash64("s1"), F.col("blocks")).alias("u3"),
        zero.alias("side"), "grp", "s1", "s2",
    )
    whole = rows.select(
        F.col("anchor").alias("u1"),
        F.pmod(F.xxhash64("s1"), F.col("chunks")).alias("u2"),
        F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("u3"),
        one.alias("side"), "grp", "s1", "s2",
    )
    return outside.unionByName(whole)


def _classes(measured: DataFrame) -> DataFrame:
    """``n, s1, s2, rep, rows``: the sets that are not empty, their smallest id and number of rows."""
    classes = measured.where(F.col("n") > 0).groupBy("n", "s1", "s2")
    return materialise(classes.agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")), "classes")


def join_links(
    df: DataFrame, size: int = 3, num: int = 90, den: int = 100, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``a, b, both``: every linked pair of different sets once, with the n-grams in common.

    ``a`` and ``b`` are structs of ``id, n, s1, s2``, with the smallest id of the rows that have the set.
    """
    t = Threshold(num, den)
    measured = materialise(measure(df, size, id, text), "measured")
    classes = _classes(measured)
    found = _hopeful_members(df, measured, classes, size, t, id, text)
    rep = measured.schema["id"].dataType.simpleString()
    if found is None:
        end = f"struct<id: {rep}, n: bigint, s1: bigint, s2: bigint>"
        return df.sparkSession.createDataFrame([], f"a {end}, b {end}, both long")
    links = materialise(_exact(found[0], found[2], classes, t, counted=False), "links")
    for end in ("a", "b"):
        named = classes.select(
            F.struct("s1", "s2").alias(end), F.struct(F.col("rep").alias("id"), "n", "s1", "s2").alias(f"{end}_named")
        )
        links = links.join(named, end).drop(end).withColumnRenamed(f"{end}_named", end)
    return links.select("a", "b", "both")


def join_components(
    df: DataFrame, size: int = 3, num: int = 90, den: int = 100, id: str = "doc_id", text: str = "text",
    counted: bool = False, chunk_rows: int | None = None,
) -> DataFrame:
    """``id, n, s1, s2, component, label``: for every row its set and the smallest id linked with it.

    Rows are linked if ``den * intersection >= num * union`` holds for their sets of n-grams of
    ``size`` words.  Only ``label``, the digest of the component's smallest class, tells components
    apart whatever the ids; it is null for a row without n-grams.  If ``counted``, ``n_links`` is the
    number of other rows that a row is linked with, rows of the same set included.  Groups are
    pruned in chunks of ``chunk_rows`` (``SIGNATURE_CHUNK``): larger ones copy fewer rows, smaller ones
    spread large groups of near copies over more tasks.  The result is the same.
    """
    t = Threshold(num, den)
    measured = materialise(measure(df, size, id, text), "measured")
    classes = _classes(measured)
    found = _hopeful_members(df, measured, classes, size, t, id, text, chunk_rows)
    links = F.col("rows") - 1
    if counted and found is not None:
        parts = _exact(found[0], found[2], classes, t, counted=True)
        counts = materialise(parts.groupBy("s1", "s2").agg(F.sum("links").alias("links")), "counts")
        classes = materialise(classes.join(counts, ["s1", "s2"], "left"), "classes")
        links += F.coalesce("links", F.lit(0))
    classes = classes.withColumn("n_links", links)
    if found is not None:
        linked = _links(*found, t)
        nodes = linked.select(F.col("node.s1").alias("s1"), F.col("node.s2").alias("s2"), "label")
        named = materialise(classes.join(nodes, ["s1", "s2"]), "nodes")
        smallest = named.groupBy("label").agg(F.min("rep").alias("component"))
        named = named.join(materialise(smallest, "names"), "label").select("n", "s1", "s2", "component", "label")
        classes = classes.join(named, ["n", "s1", "s2"], "left")
        # A component of null ids only has no smallest id, but a label.
        classes = classes.select(
            "n", "s1", "s2",
            F.when(F.col("label").isNull(), F.col("rep")).otherwise(F.col("component")).alias("component"),
            F.coalesce("label", F.struct("s1", "s2")).alias("label"),
            "n_links",
        )
    else:
        classes = classes.withColumnRenamed("rep", "component").withColumn("label", F.struct("s1", "s2"))
    joined = measured.join(classes, ["n", "s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    n_links = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if counted else []
    return joined.select("id", "n", "s1", "s2", component.alias("component"), "label", *n_links)


def keep_first(
    df: DataFrame, size: int = 5, num: int = 80, den: int = 100, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of each component: the row with the smallest id, with all its columns.

    With unique ids, the ids that go are joined with the documents.  Repeated or null ids make the
    digest of the set part of the key, and equal rows stay once; unlinked rows all stay, also those
    that share an id or have none.
    """
    found = materialise(join_components(df, size, num, den, id, text), "joined")
    rows, ids, distinct = found.agg(F.count(F.lit(1)), F.count("id"), F.count_distinct("id")).first()
    stays = (F.col("n") == 0) | F.col("id").eqNullSafe(F.col("component"))
    if rows == ids == distinct:
        gone = materialise(found.where(~stays).select(F.col("id").alias("_gone")), "gone")
        return df.join(broadcast_ids(gone, "_gone"), F.col(id) == F.col("_gone"), "left_anti")
    return _keep_of_repeated(df, found, stays, size, id, text)


def _keep_of_repeated(df: DataFrame, found: DataFrame, stays, size: int, id: str, text: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(df.schema.fields)]
        + [T.StructField(c, T.LongType()) for c in ("_n", "_s1", "_s2")]
    )
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at, column in pieces(batch.column(place)):
                more = zip(*((len(g), *digests(g)) for g in sets_of(column, hasher, size)), strict=True)
                columns = [*batch.slice(at, len(column)).columns, *(pa.array(c, pa.int64()) for c in more)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    own = f"_c{df.columns.index(id)}"
    # Of a component, one class stays: that of the smallest digest among those with the smallest id.
    # Unlinked texts may share their id, or have none, so the label tells the components apart.
    first = found.where(stays & (F.col("n") > 0)).groupBy("label", F.col("component").alias("_of")).agg(
        F.min(F.struct("n", "s1", "s2")).alias("first")
    )
    chosen = materialise(first.select("_of", "first.n", "first.s1", "first.s2"), "chosen")
    same = (
        F.col(own).eqNullSafe(F.col("_of")) & (F.col("_n") == F.col("n")) & (F.col("_s1") == F.col("s1")) & (F.col("_s2") == F.col("s2"))
    )
    marked = df.toDF(*[f"_c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)
    bare = marked.where(F.col("_n") == 0)
    full = marked.join(chosen, same, "left_semi").dropDuplicates([own, "_n", "_s1", "_s2"])
    out = bare.unionByName(full)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(df.columns)])
