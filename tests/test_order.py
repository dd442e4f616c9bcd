import random

import pytest
from pyspark.sql import functions as F

from textloom.operators.order import file_position, global_position, running_total


def expected_totals(rows):
    """``{(part, key): (before, whole)}`` of (part, key, value) rows."""
    out, seen, whole = {}, {}, {}
    for part, _, value in rows:
        whole[part] = whole.get(part, 0) + value
    for part, key, value in sorted(rows):
        out[part, key] = (seen.get(part, 0), whole[part])
        seen[part] = seen.get(part, 0) + value
    return out


@pytest.mark.parametrize("layout", ["few", "many", "hot", "single"])
def test_running_total_matches_brute_force(spark, layout):
    rng = random.Random(layout)
    parts = {
        "few": lambda i: "ab"[i % 2],
        "many": lambda i: f"p{i % 700}",
        "hot": lambda i: "hot" if i % 3 == 0 else f"p{i % 50}",
        "single": lambda i: "x",
    }[layout]
    keys = rng.sample(range(-(10**12), 10**12), 2000)
    rows = [(parts(i), k, rng.randint(0, 9)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "part string, key long, value long").repartition(7)
    got = running_total(df, "key", F.col("value"), parts=["part"], whole="whole")
    assert {(r.part, r.key): (r.start, r.whole) for r in got.collect()} == expected_totals(rows)


def test_running_total_without_parts(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = running_total(df, "k", F.col("k")).collect()
    assert {r.k: r.start for r in got} == {k: k * (k - 1) // 2 for k in range(1000)}


@pytest.mark.parametrize(
    "keys",
    [[], [5], list(range(10, 200)), [0, 1, 3, 4], [2**40, 7, -3, 2**62], [0, 1, 1 << 33]],
)
def test_position_of_integer_keys(spark, keys):
    df = spark.createDataFrame([(k, f"t{k}") for k in keys], "k long, t string").repartition(3)
    got = {r.k: (r.pos, r.t) for r in global_position(df, "k").collect()}
    assert got == {k: (i, f"t{k}") for i, k in enumerate(sorted(keys))}


def test_repeated_keys_are_not_taken_for_dense(spark):
    # Three rows span 0..2, but one key is missing and one is there twice.
    df = spark.createDataFrame([(0,), (2,), (2,)], "k long")
    assert sorted(r.pos for r in global_position(df, "k").collect()) == [0, 1, 2]


def test_position_by_descending_and_string_keys(spark):
    rows = [(i * 37 % 11, f"w{i * 13 % 300:03d}") for i in range(300)]
    df = spark.createDataFrame(rows, "n long, w string")
    got = global_position(df, ["n", "w"], descending=["n"]).orderBy("pos").collect()
    assert [(r.n, r.w) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [r.pos for r in got] == list(range(300))


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_position_is_independent_of_partitioning(spark, partitions):
    df = spark.range(500).select((F.col("id") * F.col("id")).alias("k")).repartition(partitions)
    got = {r.k: r.pos for r in global_position(df, "k").collect()}
    assert got == {i * i: i for i in range(500)}


def test_file_position_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 5).write.parquet(path)
    got = {r.id: r.pos for r in file_position(spark.read.parquet(path)).collect()}
    assert got == {i: i for i in range(1000)}


def test_no_single_task_or_cross_join_in_the_plan(spark, capsys):
    df = spark.range(1000).select((F.col("id") * 3).alias("k"), F.lit("x").alias("t"))
    global_position(df, "k").explain()
    plan = capsys.readouterr().out
    assert "SinglePartition" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_row_is_lost_for_null_parts_and_keys(spark):
    rows = [(None if i % 3 == 0 else "a", None if i == 5 else i, f"t{i}") for i in range(90)]
    df = spark.createDataFrame(rows, "part string, k long, text string").repartition(4)
    got = global_position(df, "k", parts=["part"]).collect()
    expected = {}
    for part in (None, "a"):
        own = sorted((r for r in rows if r[0] == part), key=lambda r: (r[1] is not None, r[1] or 0))
        expected.update({r[2]: at for at, r in enumerate(own)})
    assert len(got) == 90 and {r.text: r.pos for r in got} == expected


def test_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, text string")
    with pytest.raises(ValueError, match="repeats"):
        global_position(df, "k")
