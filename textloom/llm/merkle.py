"""Merkle manifest of a table: only every few levels are kept, the others are made again for proofs.

A row's leaf is the SHA-256 of its columns.  The leaves of a part (say, a language) ascend by id;
runs of ``ARITY`` neighbours become their digest until one node, the part's subroot, remains, and
the subroots make a tree of the same kind, whose top is the root.

*Checkpoints.*  Only every ``KEPT``-th level is written.  A group of ``ARITY ** KEPT`` neighbours of
a kept level is an aligned subtree: one task has its nodes, makes the levels up to the next kept one
in memory, and gives back the top alone.  So a level costs one shuffle of the nodes below it, and
what is stored above the leaves is less than a five-hundredth of them.

*Proofs.*  From the root down, each aligned subtree is made again from its kept nodes, together with
the path of its top; the siblings of all its nodes are given out, and the levels in between are
forgotten.  The path of a top is shipped once for its subtree, not once for every leaf.

A part may hold any share of the rows: positions come from range totals, subtrees are of bounded
size, and the driver sees nothing but whether a level has more than one node.

Defined results: a null column, also a null part or id, counts as ``-``, any other value as its
length in UTF-8 bytes, a colon and the value, so an empty text differs from a null one; null parts
and null ids come first; rows of the same id follow each other by their leaf, and equal rows are
leaves of their own; an empty table has no root and no proofs; texts of any length are hashed whole;
other columns are not read.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.order import running_total
from textloom.sources.scratch import materialise

ARITY = 8
KEPT = 3
SPAN = ARITY**KEPT
SIZE = 32

NODES = ["part", "pos", "n", "digest"]
PATH = T.ArrayType(
    T.StructType([T.StructField("place", T.IntegerType()), T.StructField("siblings", T.BinaryType())])
)
STEP = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.binary())]))

Path = list[tuple[int, bytes]]


# ---- digests -------------------------------------------------------------------------------------


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns, each with its length, as 32 bytes."""
    parts = []
    for column in columns:
        value = column.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def join_digests(digests: bytes) -> bytes:
    """The digest of digests, which go in as lower-case hexadecimal text."""
    return sha256(hexlify(digests)).digest()


def height(n: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n = -(-n // ARITY)
        levels += 1
    return levels


def levels_above(nodes: list[bytes], steps: int) -> list[list[bytes]]:
    """The nodes, and ``steps`` levels above them."""
    levels = [nodes]
    for _ in range(steps):
        below = levels[-1]
        levels.append([join_digests(b"".join(below[k : k + ARITY])) for k in range(0, len(below), ARITY)])
    return levels


def paths_within(levels: list[list[bytes]]) -> list[Path]:
    """For each node of the lowest level its place in its run and the run's other digests, level by level."""
    steps = []
    for level in levels[:-1]:
        runs = [level[k : k + ARITY] for k in range(0, len(level), ARITY)]
        steps.append(
            [(place, b"".join(run[:place] + run[place + 1 :])) for run in runs for place in range(len(run))]
        )
    return [[step[i // ARITY**up] for up, step in enumerate(steps)] for i in range(len(levels[0]))]


def fold(digest: bytes, path: Path) -> bytes:
    """The root that a leaf and the siblings along its path give."""
    for place, siblings in path:
        at = SIZE * place
        digest = join_digests(siblings[:at] + digest + siblings[at:])
    return digest


def path_digest(path: Path) -> bytes:
    return join_digests(b"".join(siblings for _, siblings in path))


# ---- the manifest --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """The kept levels of all parts and of the tree over their subroots, the lowest first.

    ``levels`` have ``part, pos, n, digest`` (``n``: nodes of this level in the part), the lowest also
    ``id`` and ``claimed``; ``crown`` has the same with ``name``, the part, in its lowest level.
    """

    levels: list[DataFrame]
    crown: list[DataFrame]
    root: bytes | None


def leaf_rows(
    df: DataFrame,
    columns: Sequence[str],
    part: str,
    id: str,
    claims: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``part, id, leaf, claimed`` of every row.

    ``claims`` are columns as somebody else claims them to be; without any, ``claimed`` is the leaf.
    """
    claims = claims or {}
    return df.select(
        F.col(part).alias("part"),
        F.col(id).alias("id"),
        leaf_digest([F.col(c) for c in columns]).alias("leaf"),
        leaf_digest([claims.get(c, F.col(c)) for c in columns]).alias("claimed"),
    )


def build(leaves: DataFrame) -> Manifest:
    """The manifest of rows ``part, id, leaf, claimed``."""
    # The ranges are sampled, so the rows are hashed once and written.
    leaves = materialise(leaves, "leaves")
    placed = running_total(leaves, ["id", "leaf", "claimed"], F.lit(1), ["part"], name="pos", whole="n")
    levels = _grow(materialise(placed.withColumnRenamed("leaf", "digest"), "leaves"))
    tops = [level.where(F.col("n") == 1).select("part", "digest") for level in levels]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    subroots = materialise(subroots, "subroots")
    ordered = running_total(subroots, ["part", "digest"], F.lit(1), name="pos", whole="n")
    ordered = ordered.select(F.lit(0).alias("part"), "pos", "n", "digest", F.col("part").alias("name"))
    crown = _grow(materialise(ordered, "crown"))
    top = crown[-1].where(F.col("n") == 1).select("digest").first()
    return Manifest(levels, crown, bytes(top[0]) if top else None)


def _block() -> Column:
    return F.call_function("div", "pos", F.lit(SPAN)).alias("block")


def _grow(nodes: DataFrame) -> list[DataFrame]:
    """Kept levels up to the one in which no part has a second node."""
    levels = [nodes]
    while not levels[-1].where(F.col("n") > 1).isEmpty():
        levels.append(materialise(_lift(levels[-1]), "level"))
    return levels


def _lift(nodes: DataFrame) -> DataFrame:
    """The next kept level: the tops of all aligned subtrees."""

    def top(subtree: pa.Table) -> pa.Table:
        subtree = subtree.sort_by("pos")
        n = subtree["n"][0].as_py()
        steps = min(KEPT, height(n))
        digest = levels_above(subtree["digest"].to_pylist(), steps)[-1]
        above = n
        for _ in range(steps):
            above = -(-above // ARITY)
        return pa.table(
            {
                "part": subtree["part"].slice(0, 1),
                "pos": subtree["block"].slice(0, 1),
                "n": pa.array([above], pa.int64()),
                "digest": pa.array(digest, pa.binary()),
            }
        )

    rows = nodes.where(F.col("n") > 1).select(*NODES, _block())
    schema = T.StructType([nodes.schema[c] for c in NODES])
    return rows.groupBy("part", "block").applyInArrow(top, schema)


def save(manifest: Manifest, path: str) -> None:
    """Write the kept levels; ids and claims stay out, so a manifest does not tell what it covers."""
    for tree, levels in (("levels", manifest.levels), ("crown", manifest.crown)):
        for k, level in enumerate(levels):
            names = [*NODES, *(c for c in ("id", "name") if c in level.columns)]
            level.select(*names).write.mode("overwrite").parquet(f"{path}/{tree}/{k}")
    meta = [(len(manifest.levels), len(manifest.crown), manifest.root)]
    spark = manifest.levels[0].sparkSession
    schema = "levels int, crown int, root binary"
    spark.createDataFrame(meta, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> Manifest:
    """A manifest that was saved; its leaves claim to be what they are."""
    meta = spark.read.parquet(f"{path}/meta").first()
    levels = [spark.read.parquet(f"{path}/levels/{k}") for k in range(meta["levels"])]
    crown = [spark.read.parquet(f"{path}/crown/{k}") for k in range(meta["crown"])]
    levels[0] = levels[0].withColumn("claimed", F.col("digest"))
    return Manifest(levels, crown, bytes(meta["root"]) if meta["root"] is not None else None)


# ---- proofs --------------------------------------------------------------------------------------


def _extract(
    levels: list[DataFrame],
    tops: DataFrame,
    carry: list[str],
    make: Callable[[pa.Table, bytes, list[Path]], dict[str, pa.Array]],
    fields: list[T.StructField],
) -> DataFrame:
    """``carry`` columns of the lowest level and what ``make`` says of its nodes and their paths.

    ``tops`` has ``part, subroot, path``: the way from each part's top to the root.
    """
    known = None
    for k in range(len(levels) - 1, -1, -1):
        nodes = levels[k]
        # A part that ends in this level goes on with the path of its top.
        ending = nodes.where(F.col("n") == 1).select(F.col("part").alias("_ends"))
        above = tops.join(ending, F.col("part").eqNullSafe(F.col("_ends")), "left_semi")
        above = above.select("part", F.lit(0).cast("long").alias("block"), "subroot", "path")
        if known is not None:
            above = above.unionByName(known.withColumnRenamed("pos", "block"))
        names = ["part", "pos"] if k else carry
        more = [above.schema["subroot"], T.StructField("path", PATH)] if k else fields
        schema = T.StructType([nodes.schema[c] for c in names] + more)
        found = _regenerate(nodes, above, names, make if k == 0 else _with_path, schema)
        if k == 0:
            return found
        known = materialise(found, "paths")
    raise ValueError("a manifest has one level at least")


def _with_path(nodes: pa.Table, subroot: bytes, paths: list[Path]) -> dict[str, pa.Array]:
    steps = [[{"place": p, "siblings": s} for p, s in path] for path in paths]
    return {"subroot": pa.array([subroot] * len(paths), pa.binary()), "path": pa.array(steps, STEP)}


def _regenerate(nodes: DataFrame, above: DataFrame, names: list[str], make, schema: T.StructType) -> DataFrame:
    """Each aligned subtree with the path of its top: what ``make`` says of all its nodes."""

    def subtree(own: pa.Table, top: pa.Table) -> pa.Table:
        own = own.sort_by("pos")
        steps = min(KEPT, height(own["n"][0].as_py()))
        rest = [(step["place"], step["siblings"]) for step in top["path"][0].as_py()]
        levels = levels_above(own["digest"].to_pylist(), steps)
        paths = [path + rest for path in paths_within(levels)]
        made = make(own, top["subroot"][0].as_py(), paths)
        return pa.table({**{c: own[c] for c in names}, **made})

    wanted = list(dict.fromkeys([*NODES, *names, *(c for c in ("claimed",) if c in nodes.columns)]))
    left = nodes.select(*wanted, _block()).groupBy("part", "block")
    # New names, as both sides may stem from one table.
    right = above.toDF("_part", "_block", "subroot", "path").groupBy("_part", "_block")
    return left.cogroup(right).applyInArrow(subtree, schema)


def _part_tops(manifest: Manifest) -> DataFrame:
    """``part, subroot, path``: every subroot and its way to the root."""
    root = F.lit(manifest.root).cast("binary")
    start = manifest.crown[-1].where(F.col("n") == 1).select(
        "part", root.alias("subroot"), F.array().cast(PATH).alias("path")
    )
    fields = [T.StructField("subroot", T.BinaryType()), T.StructField("path", PATH)]

    def make(nodes: pa.Table, _: bytes, paths: list[Path]) -> dict[str, pa.Array]:
        made = _with_path(nodes, b"", paths)
        return {**made, "subroot": nodes["digest"].combine_chunks()}

    found = _extract(manifest.crown, start, ["name"], make, fields)
    return materialise(found.withColumnRenamed("name", "part"), "tops")


def prove(manifest: Manifest) -> DataFrame:
    """``id, digest, subroot, path``: every leaf and its whole proof, a list of ``place, siblings``."""
    fields = [T.StructField("subroot", T.BinaryType()), T.StructField("path", PATH)]
    return _extract(manifest.levels, _part_tops(manifest), ["id", "digest"], _with_path, fields)


def audit(manifest: Manifest) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every leaf, in hexadecimal.

    The proofs are digested, and the claimed leaves folded along them, where they are made.
    """
    names = ["leaf", "subroot", "proof_sha256", "folded_root"]

    def make(nodes: pa.Table, subroot: bytes, paths: list[Path]) -> dict[str, pa.Array]:
        leaves, claimed = nodes["digest"].to_pylist(), nodes["claimed"].to_pylist()
        columns = (
            [leaf.hex() for leaf in leaves],
            [subroot.hex()] * len(leaves),
            [path_digest(path).hex() for path in paths],
            [fold(leaf, path).hex() for leaf, path in zip(claimed, paths, strict=True)],
        )
        return {c: pa.array(v, pa.string()) for c, v in zip(names, columns, strict=True)}

    fields = [T.StructField(c, T.StringType()) for c in names]
    found = _extract(manifest.levels, _part_tops(manifest), ["id"], make, fields)
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    return found.select(
        "id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
