"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie.  Every node has a failure link: where a match can go no further, the
greedy pieces of what was read are popped and reading goes on from the longest rest.  The number of
popped pieces is precomputed for each link, so that the length of a text in greedy longest-match
pieces comes from one pass over its bytes and no piece is ever built.  A batch's distinct words step
through the automaton together, one byte per step, by binary search over the sorted edges.

Words are cut as in ``wordpiece`` tokenizers: white space, then each punctuation mark by itself;
A-Z is folded.  A word that the vocabulary cannot cover counts as one unknown piece.

Defined results: null and empty texts have no tokens; repeated rows are counted alike; only
``keep`` and the text are read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.bpe import Bpe, byte_symbols
from textloom.llm.words import FOLDED_VALUES, Hasher, flat, pieces, word_bounds

DEAD = -1
END_BYTE = 256
CACHE_WORDS = 1 << 21

FOLD = np.arange(256, dtype=np.int64)
FOLD[65:91] += 32
IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
IS_MARK = ~IS_LETTER
IS_MARK[[32, 9, 10, 11, 12, 13]] = False


class Automaton:
    """Trie, failure links and popped-piece counts of a set of pieces.

    ``starts`` are the pieces that may begin a word, ``inner`` those that may follow; all are tuples
    of byte codes, and ``END_BYTE`` closes a word, so that a piece can demand the end of it.
    """

    def __init__(self, starts: Iterable[tuple[int, ...]], inner: Iterable[tuple[int, ...]]):
        # Node 0 is the root for word starts, node 1 the root for what follows.
        children: list[dict[int, int]] = [{}, {}]
        piece = [False, False]
        for root, pieces_of in ((0, starts), (1, inner)):
            for codes in pieces_of:
                node = root
                for code in codes:
                    if code not in children[node]:
                        children[node][code] = len(children)
                        children.append({})
                        piece.append(False)
                    node = children[node][code]
                piece[node] = True
        n = len(children)
        fail, pops = np.full(n, DEAD), np.zeros(n, dtype=np.int64)
        # Breadth first: the link of a node follows its parent's link along the same byte.
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for code, child in children[node].items():
                if piece[child]:
                    fail[child], pops[child] = 1, 1
                else:
                    at, popped = fail[node], pops[node]
                    while at != DEAD and code not in children[at]:
                        popped += pops[at]
                        at = fail[at]
                    if at != DEAD:
                        fail[child], pops[child] = children[at][code], popped
                queue.append(child)
        edges = sorted((node * 512 + code, child) for node, kids in enumerate(children) for code, child in kids.items())
        self.keys = np.array([k for k, _ in edges], dtype=np.int64)
        self.targets = np.array([t for _, t in edges], dtype=np.int64)
        self.fail, self.pops = fail, pops

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word given as a range of byte codes; 1 where none fit."""
        total = np.zeros(len(starts), dtype=np.int64)
        order = np.argsort(ends - starts, kind="stable")
        length = (ends - starts)[order]
        node = np.zeros(len(starts), dtype=np.int64)
        dead = np.zeros(len(starts), dtype=bool)
        for step in range(int(length[-1]) + 1 if len(length) else 0):
            # Words of this length or more are still reading; the closing code comes last.
            active = order[np.searchsorted(length, step) :]
            active = active[~dead[active]]
            if not len(active):
                continue
            inside = starts[active] + step
            code = np.where(inside < ends[active], data[np.minimum(inside, len(data) - 1)], END_BYTE)
            while len(active):
                wanted = node[active] * 512 + code
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                hit = self.keys[at] == wanted
                node[active[hit]] = self.targets[at[hit]]
                active, code = active[~hit], code[~hit]
                # At the closing code, the root of what follows means that all was popped.
                finished = (node[active] == 1) & (code == END_BYTE)
                active, code = active[~finished], code[~finished]
                total[active] += self.pops[node[active]]
                node[active] = self.fail[node[active]]
                lost = node[active] == DEAD
                dead[active[lost]] = True
                active, code = active[~lost], code[~lost]
        # What is left in the trie after the end pops along the links.
        left = np.flatnonzero(~dead & (node != 1))
        while len(left):
            total[left] += self.pops[node[left]]
            node[left] = self.fail[node[left]]
            dead[left[node[left] == DEAD]] = True
            left = left[(node[left] != 1) & (node[left] != DEAD)]
        return np.where(dead, 1, total)


def from_bpe(bpe: Bpe) -> Automaton:
    """Pieces of a BPE file with word ends, taken as a word-piece vocabulary.

    A token with the end mark closes a word, others do not; both may stand at any place in it.
    """
    codes = {c: b for b, c in enumerate(byte_symbols())}
    found = []
    for token in bpe.tokens:
        if token and token not in bpe.specials:
            closes = token.endswith("</w>")
            body = token.removesuffix("</w>") if closes else token
            found.append(tuple(int(FOLD[codes[c]]) for c in body) + ((END_BYTE,) if closes else ()))
    return Automaton(found, found)


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters and digits, and single marks; with the first of each text."""
    starts, ends, _ = word_bounds(IS_LETTER[data], offsets)
    marks = np.flatnonzero(IS_MARK[data])
    starts, ends = np.concatenate((starts, marks)), np.concatenate((ends, marks + 1))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    return starts, ends, np.searchsorted(starts, offsets)


class Counter:
    """Counts the pieces of texts; remembers words by hash in a bounded cache."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.hasher = automaton, Hasher(FOLDED_VALUES)
        self.known, self.pieces = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, column: pa.Array) -> np.ndarray:
        data, offsets = flat(column)
        starts, ends, first = word_ranges(data, offsets)
        hashes = self.hasher.ranges(self.hasher.totals(data), starts, ends)
        names, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, names), max(len(self.known) - 1, 0))
        seen = self.known[at] == names if len(self.known) else np.zeros(len(names), bool)
        counts = np.zeros(len(names), dtype=np.int64)
        counts[seen] = self.pieces[at[seen]] if len(self.known) else 0
        fresh = where[~seen]
        counts[~seen] = self.automaton.counts(FOLD[data], starts[fresh], ends[fresh])
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known, self.pieces = names, counts
        elif len(fresh):
            merged = np.concatenate((self.known, names[~seen]))
            order = np.argsort(merged, kind="stable")
            self.known = merged[order]
            self.pieces = np.concatenate((self.pieces, counts[~seen]))[order]
        sums = np.concatenate(([0], np.cumsum(counts[back])))
        return np.diff(sums[first])


def count_tokens(
    df: DataFrame, automaton: Automaton, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep, n_tokens`` for every row."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(automaton)
        for batch in batches:
            for at, column in pieces(batch.column(len(keep))):
                taken = batch.slice(at, len(column))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns[: len(keep)], pa.array(counter.count(column), pa.int64())],
                    names=[*keep, "n_tokens"],
                )

    return df.select(*keep, F.col(text).alias("_read")).mapInArrow(run, schema)
