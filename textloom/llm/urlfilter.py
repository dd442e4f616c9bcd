"""URL rules as a sort-merge range join.

A host is turned round, label by label, each closed by a dot, so that a host and its subdomains
share a prefix: every rule is an interval of the sorted keys, and intervals nest or are apart.
The URLs are range-partitioned and sorted by key; each task sweeps its sorted rows once with a
stack of the rules whose interval is open, and takes the longest of them whose path also fits.

Rules are handled in blocks of at most ``MAX_RULES``; every block sweeps the same sorted rows, and
the best match is carried along, so there is no limit on their number.

Defined results: a null URL or one without ``://`` has an empty host and path; a URL that no rule
fits gets the default verdict and a null rule; among rules of equal length that fit, the one with
the longer host wins.  Every row yields a row, also repeated ones; only ``keep`` and the URL are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @classmethod
    def parse(cls, verdict: str, pattern: str) -> Rule:
        """From ``host/path``, such as ``example.net/en/``."""
        host, slash, path = pattern.partition("/")
        if not host or not slash or verdict not in ("allow", "block"):
            raise ValueError(f"a rule is allow or block and host/path, not {verdict} {pattern!r}")
        return cls(host.translate(_FOLD), slash + path, verdict)

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def key(self) -> str:
        return "".join(label + "." for label in reversed(self.host.split(".")))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def sweep(
    keys: list[str], paths: list[str], best: list[str | None], verdicts: list[str | None], rules: list[Rule]
) -> tuple[list[str | None], list[str | None]]:
    """The longest fitting rule of each row, where it beats ``best``; ``keys`` are sorted."""
    stack: list[tuple[str, list[Rule]]] = []
    at, rule_keys = 0, [r.key for r in rules]
    last: str | None = None
    for row, key in enumerate(keys):
        if key != last:
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            while at < len(rules) and rule_keys[at] <= key:
                if key.startswith(rule_keys[at]):
                    if stack and stack[-1][0] == rule_keys[at]:
                        stack[-1][1].append(rules[at])
                    else:
                        stack.append((rule_keys[at], [rules[at]]))
                at += 1
            last = key
        for _, opened in reversed(stack):
            for rule in opened:
                if paths[row].startswith(rule.path) and len(rule.text) > len(best[row] or ""):
                    best[row], verdicts[row] = rule.text, rule.verdict
    return best, verdicts


def filter_urls(
    df: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
    default: str = "allow",
) -> DataFrame:
    """``keep, host, path, rule, verdict`` for every row."""
    spark = df.sparkSession
    host = host_of(F.col(url))
    rows = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], host.alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumns({"key": host_key(F.col("host")), "rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    order = ["key", "path", *[f"_k{i}" for i in range(len(keep))]]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions("key")
    ordered = sorted(rules, key=lambda r: r.key)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    for start in range(0, len(ordered), MAX_RULES):
        rows = rows.mapInArrow(_block(ordered[start : start + MAX_RULES], len(keep)), schema)
    return rows.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )


def _block(rules: list[Rule], kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, key, best, verdict = (
                batch.column(kept + i).to_pylist() for i in (1, 2, 3, 4)
            )
            best, verdict = sweep(key, path, best, verdict, rules)
            columns = [*batch.columns[: kept + 3], pa.array(best, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run
