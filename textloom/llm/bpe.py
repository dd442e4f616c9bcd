"""Byte-pair encoding and decoding in batched merge rounds.

The words of a batch lie in one flat array of symbols.  Every round looks the ranks of changed
neighbours up by binary search in the sorted pair keys, takes the lowest rank of each word and
merges it.  All places of that pair in a word merge in one round where that cannot change the
result, which is known for each merge beforehand; else only the leftmost one does.  Words that
have no pair left leave the array.

Defined results: a null text counts as empty, an empty text has no ids and decodes to an empty
string; repeated rows give repeated results; other columns are only read if named in ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.words import pieces

END = "</w>"
MARKS = frozenset('.,;:!?#$%&*"|')
NEVER = np.int64(2**62)
CACHE_WORDS = 1 << 18
CACHE_CHARS = 1 << 24


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """A byte-level BPE with word ends, read from the text of a tokenizer file."""

    def __init__(self, description: str):
        spec = json.loads(description)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END:
            raise ValueError("not a BPE file with word ends")
        if steps != ["NFC", "Replace", "Lowercase"] or not split["invert"]:
            raise ValueError("unknown normalizer or splitter")
        self.pattern = split["pattern"]["Regex"]
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in (*vocab.items(), *self.specials.items())}
        self.size = max(by_id) + 1
        self.tokens = [by_id.get(i, "") for i in range(self.size)]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.final = np.array([vocab[s + END] for s in symbols], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        ranks = np.arange(len(pairs), dtype=np.int64)
        order = np.argsort(left * self.size + right)
        self.keys = (left * self.size + right)[order]
        self.ranks, self.made = ranks[order], made
        lowest = np.full(self.size, NEVER)
        np.minimum.at(lowest, left, ranks)
        np.minimum.at(lowest, right, ranks)
        # All places at once: no pair with the new symbol goes before the pair itself.
        self.at_once = lowest[made] > ranks

    @classmethod
    def load(cls, path: str) -> Bpe:
        """Read on the driver; the object travels with the job (some MB, fixed by the file)."""
        with open(path, encoding="utf-8") as file:
            return cls(file.read())

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)

    def merge(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words given as flat symbols; returns flat ids and ids per word."""
        word = np.repeat(np.arange(len(counts)), counts)
        rank = np.full(len(symbols), NEVER)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self._rank(symbols[inside], symbols[inside + 1])
        done_ids, done_words = [], []
        while len(symbols):
            heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            spans = np.diff(np.append(heads, len(word)))
            lowest = np.minimum.reduceat(rank, heads)
            over = np.repeat(lowest == NEVER, spans)
            if over.any():
                done_ids.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank = symbols[~over], word[~over], rank[~over]
                if not len(symbols):
                    break
                spans = spans[lowest != NEVER]
                lowest = lowest[lowest != NEVER]
            places = np.flatnonzero(rank == np.repeat(lowest, spans))
            ranks = rank[places]
            first = np.concatenate(([True], word[places][1:] != word[places][:-1]))
            keep = first | self.at_once[ranks]
            # In a run such as "aaa" only every second pair can merge.
            near = np.concatenate(([False], (np.diff(places) == 1))) & ~first
            if near.any():
                run = np.maximum.accumulate(np.where(~near, np.arange(len(places)), 0))
                keep &= (np.arange(len(places)) - run) % 2 == 0
            places, ranks = places[keep], ranks[keep]
            symbols[places] = self.made[ranks]
            stay = np.ones(len(symbols), dtype=bool)
            stay[places + 1] = False
            at = places - np.arange(len(places))
            symbols, word, rank = symbols[stay], word[stay], rank[stay]
            touched = np.unique(np.concatenate((at, at[at > 0] - 1)))
            rank[touched] = NEVER
            follow = touched[touched + 1 < len(symbols)]
            follow = follow[word[follow] == word[follow + 1]]
            rank[follow] = self._rank(symbols[follow], symbols[follow + 1])
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(counts), np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(counts))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        counts = np.array([len(w) for w in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(counts) - 1
        symbols[last] = self.final[data[last]]
        return self.merge(symbols, counts)

    def encoder(self) -> Encoder:
        return Encoder(self)

    def decode(self, ids: Sequence[int]) -> str:
        """Tokens joined by spaces, specials included, as a file without a decoder has it."""
        return " ".join(map(self.tokens.__getitem__, ids))


class Codes(dict):
    """Numbers for chunks in the order of their first sight; new ones are listed."""

    def __init__(self, first: int):
        self.next, self.chars, self.fresh = first, 0, []

    def __missing__(self, chunk: str) -> int:
        code = self[chunk] = self.next
        self.next += 1
        self.chars += len(chunk)
        self.fresh.append(chunk)
        return code


class Encoder:
    """Encodes texts; remembers the ids of chunks between white space in a bounded cache."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.find = regex.compile(bpe.pattern.replace(r"\s", r"\p{White_Space}")).findall
        # str.split() cuts at four control characters that are no white space in Unicode.
        self.odd = regex.compile("[\x1c-\x1f]").search
        self.chunks = regex.compile(r"\P{White_Space}+").findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, bpe.specials)) + ")")
        self.marks = {t[:2] for t in bpe.specials}
        self._clear()

    def _clear(self) -> None:
        self.known = Codes(len(self.bpe.specials))
        self.special_codes = {t: k for k, t in enumerate(self.bpe.specials)}
        self.flat = np.array(list(self.bpe.specials.values()), dtype=np.int64)
        self.begin = np.arange(len(self.flat))
        self.count = np.ones(len(self.flat), dtype=np.int64)

    def _parts(self, text: str) -> Iterator[tuple[bool, str]]:
        if any(mark in text for mark in self.marks):
            for k, part in enumerate(self.special.split(text)):
                if part:
                    yield k % 2 == 1, part
        elif text:
            yield False, text

    def _chunks(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Every character by itself: a final sigma is not a case of its own here.
        text = "".join(c.lower() for c in text) if "\u03a3" in text else text.lower()
        return self.chunks(text) if self.odd(text) else text.split()

    def _words(self, chunk: str) -> list[str]:
        """The words of the file's pattern; letters alone, or with one mark after them, are plain."""
        if chunk.isalpha():
            return [chunk]
        if chunk[-1] in MARKS and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.find(chunk)

    def _learn(self, fresh: list[str]) -> None:
        split = [self._words(c) for c in fresh]
        distinct = {w: 0 for ws in split for w in ws}
        words = list(distinct)
        for k, w in enumerate(words):
            distinct[w] = k
        ids, counts = self.bpe.encode_words(words) if words else (np.zeros(0, np.int64),) * 2
        ends = np.cumsum(counts)
        of = np.array([distinct[w] for ws in split for w in ws], dtype=np.int64)
        per = np.array([len(ws) for ws in split], dtype=np.int64)
        taken = counts[of] if len(of) else np.zeros(0, np.int64)
        flat = gather(ids, (ends - counts)[of] if len(of) else taken, taken)
        bounds = np.concatenate(([0], np.cumsum(taken)))[np.concatenate(([0], np.cumsum(per)))]
        base = len(self.flat)
        self.flat = np.concatenate((self.flat, flat))
        self.begin = np.concatenate((self.begin, base + bounds[:-1]))
        self.count = np.concatenate((self.count, np.diff(bounds)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the offsets of each text."""
        if len(self.known) > CACHE_WORDS or self.known.chars > CACHE_CHARS:
            self._clear()
        code_of, codes, sizes = self.known.__getitem__, [], []
        self.known.fresh = fresh = []
        for text in texts:
            before = len(codes)
            for is_special, part in self._parts(text or ""):
                if is_special:
                    codes.append(self.special_codes[part])
                else:
                    codes.extend(map(code_of, self._chunks(part)))
            sizes.append(len(codes) - before)
        if fresh:
            self._learn(fresh)
        code = np.array(codes, dtype=np.int64)
        taken = self.count[code]
        ids = gather(self.flat, self.begin[code], taken)
        bounds = np.concatenate(([0], np.cumsum(taken)))
        return ids, bounds[np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)]


def gather(values: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``values[b : b + c]`` for all pairs, one after the other."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begin - (ends - count), count)]


def encode(
    df: DataFrame, bpe: Bpe, text: str = "text", keep: Sequence[str] = ("doc_id",), name: str = "input_ids"
) -> DataFrame:
    """``keep`` columns and the ids of every whole text."""
    schema = T.StructType(
        [df.schema[c] for c in keep] + [T.StructField(name, T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder()
        for batch in batches:
            for at, column in pieces(batch.column(len(keep))):
                ids, offsets = encoder.encode(column.to_pylist())
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, type=pa.int32()), pa.array(ids, type=pa.int32())
                )
                rows = batch.slice(at, len(column))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[: len(keep)], lists], names=[*keep, name]
                )

    return df.select(*keep, text).mapInArrow(run, schema)


def decode(
    df: DataFrame, bpe: Bpe, ids: str = "input_ids", keep: Sequence[str] = ("doc_id",), name: str = "text"
) -> DataFrame:
    """``keep`` columns and the decoded text of the ids; null ids count as none."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [bpe.decode(row or ()) for row in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, type=pa.string())],
                names=[*keep, name],
            )

    return df.select(*keep, ids).mapInArrow(run, schema)


def roundtrip_digests(
    df: DataFrame, bpe: Bpe, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``n_tokens, ids_sha256, decoded_sha256``: encode, decode from the ids, digest."""
    more = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(*m) for m in more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder()
        for batch in batches:
            for at, column in pieces(batch.column(len(keep))):
                ids, offsets = encoder.encode(column.to_pylist())
                exact = ids.astype("<u4")
                rows = [exact[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                coded = [hashlib.sha256(r.tobytes()).hexdigest() for r in rows]
                plain = [
                    hashlib.sha256(bpe.decode(r.tolist()).encode()).hexdigest() for r in rows
                ]
                taken = batch.slice(at, len(column))
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns[: len(keep)],
                        pa.array(np.diff(offsets), type=pa.int64()),
                        pa.array(coded, type=pa.string()),
                        pa.array(plain, type=pa.string()),
                    ],
                    names=[*keep, *(m[0] for m in more)],
                )

    return df.select(*keep, text).mapInArrow(run, schema)
