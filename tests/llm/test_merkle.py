"""The manifest against a plain tree, its proofs, and the cases named in the docstring."""

import hashlib
import string
import zlib

import pytest
from pyspark.sql import functions as F

import oracle
from textloom.llm import merkle, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, part string, leaf string, pos int"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [*(row[c] for c in COLUMNS[:4]), text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[k : k + 8])) for k in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = at - at % 8
        out.append((at % 8, [d for k, d in enumerate(level[run : run + 8], run) if k != at]))
        at //= 8
    return out


def brute(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root of every row, sorted."""
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, placed = {}, {}
    for lang in langs:
        own = [(r, leaf(r, r["text"])) for r in rows if r["lang"] == lang]
        placed[lang] = sorted(own, key=lambda x: (first(x[0]["doc_id"]), x[1]))
        trees[lang] = tree([d for _, d in placed[lang]])
    top = tree([trees[lang][-1][0] for lang in langs]) if langs else None
    out = []
    for k, lang in enumerate(langs):
        for at, (r, own) in enumerate(placed[lang]):
            path = siblings(trees[lang], at) + siblings(top, k)
            text, id = r["text"], r["doc_id"]
            if text is not None and id is not None and zlib.crc32(str(id).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest = leaf(r, text)
            for place, others in path:
                digest = H("".join(others[:place]) + digest + "".join(others[place:]))
            proof = H("".join(d for _, others in path for d in others))
            out.append((id, own, trees[lang][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    id, text = F.col("doc_id"), F.col("text")
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    lowered = F.when(F.crc32(id.cast("string")) % 3 == 0, folded).otherwise(text)
    manifest = merkle.build(merkle.leaf_rows(df, COLUMNS, "lang", "doc_id", claims={"text": lowered}))
    columns = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in merkle.audit(manifest).select(*columns).collect()), key=repr), manifest


def make(sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [(len(rows) + k, f"s{k % 3}", lang, k, f"Text {k} ÄB", "x", "y", 1) for k in range(n)]
    return rows


def as_dicts(rows):
    return [dict(zip(COLUMNS, r, strict=False)) for r in rows]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 9, "b": 1, "c": 8, None: 3}, {"é": 65, "z": 513, "": 2}])
def test_manifest_equals_a_plain_tree(spark, sizes):
    rows = make(sizes)
    assert got(spark, rows)[0] == brute(as_dicts(rows))


def test_more_levels_than_one_subtree(spark, monkeypatch):
    """Fewer kept levels give the same digests; more parts than one subtree of the crown."""
    monkeypatch.setattr(merkle, "KEPT", 1)
    monkeypatch.setattr(merkle, "SPAN", merkle.ARITY)
    rows = make({"a": 130, **{f"p{k:03}": 1 + k % 3 for k in range(70)}})
    found, manifest = got(spark, rows)
    assert found == brute(as_dicts(rows))
    assert len(manifest.levels) == 4 and len(manifest.crown) == 4


def test_nulls_repeated_rows_and_long_texts(spark):
    rows = make({"a": 5})
    rows += [(None, None, None, None, None, "x", "y", 1)] * 3
    rows += [(2, "s", "a", 1, "twice", "x", "y", 1)] * 2 + [(2, "s", "a", 1, "other", "x", "y", 1)]
    rows += [(7, "s", "a", 1, "", "x", "y", 1), (8, "s", "a", 1, None, "x", "y", 1), (9, "s", "a", 1, "Ab " * 300_000, "x", "y", 1)]
    assert got(spark, rows)[0] == brute(as_dicts(rows))


def test_empty_table(spark, tmp_path):
    found, manifest = got(spark, [])
    assert found == [] and manifest.root is None and merkle.prove(manifest).count() == 0
    merkle.save(manifest, str(tmp_path / "m"))
    assert merkle.load(spark, str(tmp_path / "m")).root is None


def test_proofs_of_a_saved_manifest(spark, tmp_path):
    _, manifest = got(spark, make({"a": 600, "b": 3}))
    merkle.save(manifest, str(tmp_path / "m"))
    again = merkle.load(spark, str(tmp_path / "m"))
    # Kept above 600 leaves: two tops of subtrees, and their top.
    assert [level.count() for level in again.levels] == [603, 3, 1]
    for row in merkle.prove(again).collect():
        path = [(s.place, bytes(s.siblings)) for s in row.path]
        assert merkle.fold(bytes(row.digest), path) == again.root
        changed = bytes(32)
        assert merkle.fold(changed, path) != again.root
    assert merkle.audit(again).where("verified").count() == 603


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    name = "op11_merkle_manifest"
    assert oracle.actual(queries.QUERIES[name](spark, sf)) == oracle.expected(oracle.connect(sf), queries.ORACLES[name])
