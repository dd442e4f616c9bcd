import pytest
from pyspark.sql import functions as F

from textloom.operators.split import (
    head_percent_split,
    head_samples,
    require_split,
    with_validation,
)


@pytest.mark.parametrize("n", [0, 1, 10, 30, 50, 70])
@pytest.mark.parametrize("pct", [0, 5, 25, 100])
def test_border_is_rounded_half_to_even(spark, n, pct):
    rows = spark.range(n).select(F.col("id").alias("pos"), F.col("id").alias("k"))
    got = head_percent_split(rows, pct).collect()
    border = round(n * pct / 100)
    expected = {
        (k, "validation", k) if k < border else (k, "train", k - border) for k in range(n)
    }
    assert {(r.k, r.split, r.pos) for r in got} == expected


def presplit(spark):
    rows = [("train", i) for i in range(20)] + [("validation", i) for i in range(3)] + [("test", 0)]
    return spark.createDataFrame(rows, "split string, pos long")


def test_given_validation_is_kept(spark):
    got = with_validation(presplit(spark), 25)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, presplit(spark).collect()))


def test_given_validation_is_replaced(spark):
    got = with_validation(presplit(spark), 25, use_presplit=False)
    counts = {r.split: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"train": 15, "validation": 5, "test": 1}
    assert {r.pos for r in got.where("split = 'train'").collect()} == set(range(15))


def test_missing_validation_is_cut_from_train(spark):
    got = with_validation(presplit(spark).where("split = 'train'"), 10)
    assert got.where("split = 'validation'").count() == 2


def test_streams_need_a_given_validation(spark, sf_dir):
    path = f"{sf_dir}/documents.parque[t]"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).parquet(path).withColumn("split", F.lit("train"))
    with pytest.raises(ValueError):
        with_validation(stream)
    with pytest.raises(ValueError):
        with_validation(stream, use_presplit=False, splits=["train", "validation"])
    with pytest.raises(ValueError):
        head_percent_split(stream)
    assert with_validation(stream, splits=["train", "validation"]).isStreaming


def test_head_samples_caps_each_split(spark):
    got = head_samples(presplit(spark), {"train": 4, "validation": 100, "test": None})
    counts = {r.split: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"train": 4, "validation": 3, "test": 1}
    assert got.where("split = 'train'").agg(F.max("pos")).first()[0] == 3


def test_required_split(spark):
    assert require_split(presplit(spark), "train").count() == 24
    with pytest.raises(ValueError):
        require_split(presplit(spark), "dev")


def test_rows_without_a_split_are_carried_along(spark):
    rows = [("train", i) for i in range(4)] + [("validation", 0), (None, 0), ("test", 0)]
    df = spark.createDataFrame(rows, "split string, pos long")
    got = with_validation(df, 25, use_presplit=False).collect()
    assert sorted(((r.split or "-"), r.pos) for r in got) == [
        ("-", 0), ("test", 0), ("train", 0), ("train", 1), ("train", 2), ("validation", 0)
    ]
