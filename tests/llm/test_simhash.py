"""Fingerprints and components against plain loops, and the cases named in the docstring."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from textloom.llm import queries, simhash

TEXTS = [
    None, "", " \t\n\x0b\x0c\r", "One", "one", "one TWO", "One  two\nthree", "a b a b a b a b", "É é ΣΑΣ İx \x1c a\x1db",
    "same words here " * 3, "Same Words here " * 3, "x " * 70_000, "中文 🎉 \x85 a b c d e",
]


def brute_print(text, size=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, ids, radius=2):
    """Smallest id of each row's component."""
    n = len(prints)
    label = list(range(n))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    known = {}
    for k in range(n):
        if ids[k] is not None:
            known[find(k)] = min(known.get(find(k), ids[k]), ids[k])
    return [known.get(find(k)) for k in range(n)]


def near(rng, count, flips):
    """Fingerprints around a few centres, so that many are within reach."""
    centres = [rng.getrandbits(64) for _ in range(max(1, count // 20))]
    out = []
    for _ in range(count):
        x = rng.choice(centres)
        for _ in range(rng.randrange(flips)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def test_fingerprints_of_slices_and_pieces(monkeypatch):
    expected = [brute_print(t) for t in TEXTS]
    for step in (1, 7, 1 << 16):
        monkeypatch.setattr(simhash, "SLICE", step if step > 1 else 1 << 10)
        assert simhash.fingerprints_of(pa.array(TEXTS)).tolist() == expected
    assert simhash.fingerprints_of(pa.array([], pa.string())).tolist() == []


def test_near_duplicates_of_texts(spark):
    rng = random.Random(5)
    base = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(400))
    texts = TEXTS + [base] * 3 + [base.replace("alpha", "Alpha", 1), base + " more", base.replace("beta", "b", 1)]
    ids = [None if k == 3 else 5 if k in (7, 8) else k for k in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, ["f"] * len(ids), strict=True)), "doc_id long, text string, fingerprint string")
    got = sorted(map(tuple, simhash.near_duplicates(df.repartition(3)).collect()), key=repr)
    prints = [brute_print(t) for t in texts]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    assert got == sorted(zip(ids, signed, brute(prints, ids), strict=True), key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("tile, inner, small", [(1 << 14, 512, 64), (16, 4, 2), (40, 8, 1)])
def test_links_and_components_of_split_groups(spark, monkeypatch, tile, inner, small):
    for name, value in (("TILE", tile), ("INNER", inner), ("SMALL", small)):
        monkeypatch.setattr(simhash, name, value)
    rng = random.Random(tile)
    # A third shares its lowest 21 bits, and is a group far above the tile.
    prints = near(rng, 300, 5) + [rng.getrandbits(43) << 21 | 99 for _ in range(150)]
    prints = list(dict.fromkeys(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(5)
    expected = {
        (min(a, b), max(a, b), (x ^ y).bit_count())
        for k, (a, x) in enumerate(zip(signed, prints, strict=True))
        for b, y in zip(signed[:k], prints[:k], strict=True)
        if (x ^ y).bit_count() <= 2
    }
    found = [tuple(r) for r in simhash.links(classes).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    rows = simhash.units(simhash.banded(classes, 2), 2)
    edges = [tuple(r) for r in simhash.forest(rows, 2).collect()]
    label = {p: p for p in signed}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in edges:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    same = {}
    for p, c in zip(signed, brute(prints, list(range(len(prints)))), strict=True):
        same.setdefault(c, set()).add(find(p))
    assert all(len(roots) == 1 for roots in same.values())
    assert len({r for roots in same.values() for r in roots}) == len(same)


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    components = brute(prints, [r.doc_id for r in rows])
    expected = [(r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows, prints, components, strict=True)]
    got = queries.QUERIES["op13_simhash_near_dedup"](spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
