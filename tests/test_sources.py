import time

import pytest
from pyspark.sql import functions as F

from textloom.sources import readers, scratch, writers

TEXTS = ['plain', 'with "quotes", commas', "two\nlines", "", "éè \U0001f600"]


def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string").coalesce(1)


@pytest.mark.parametrize("extension", ["csv", "json"])
def test_files_round_trip(spark, tmp_path, extension):
    path = f"{tmp_path}/train.{extension}"
    writer = corpus(spark).write
    if extension == "csv":
        writer.csv(path, header=True, escape='"', quoteAll=True, emptyValue="")
    else:
        writer.json(path)
    got = readers.load_files(spark, train=path, schema="k long, text string", ordered=True).collect()
    assert {(r.split, r.pos, r.k, r.text or "") for r in got} == {
        ("train", i, i, t) for i, t in enumerate(TEXTS)
    }


def test_text_files_keep_their_line_order(spark, tmp_path):
    for split in ("train", "validation"):
        folder = tmp_path / f"{split}.txt"
        folder.mkdir()
        for part in range(3):
            lines = [f"{split} {part} {i}" for i in range(200)]
            (folder / f"part-{part}.txt").write_text("\n".join(lines) + "\n")
    paths = {s: f"{tmp_path}/{s}.txt" for s in ("train", "validation")}
    got = readers.load_files(spark, **paths, keep_linebreaks=True, ordered=True)
    expected = {
        (s, p * 200 + i, f"{s} {p} {i}\n") for s in paths for p in range(3) for i in range(200)
    }
    assert {(r.split, r.pos, r.text) for r in got.collect()} == expected
    plain = readers.load_files(spark, validation=paths["validation"])
    assert plain.columns == ["text", "split"] and plain.count() == 600
    assert plain.first().split == "validation"


def test_a_file_must_be_named(spark):
    with pytest.raises(ValueError):
        readers.load_files(spark)
    with pytest.raises(ValueError):
        readers.load_files(spark, train="x.docx")


def test_corpus_splits(spark, tmp_path):
    writers.save_prepared(corpus(spark).withColumn("split", F.when(F.col("k") < 2, "train").otherwise("test")), f"{tmp_path}/c")
    assert readers.load_corpus(spark, str(tmp_path), "c").count() == 5
    assert readers.load_corpus(spark, str(tmp_path), "c", "train").count() == 2
    corpus(spark).write.parquet(f"{tmp_path}/d")
    assert readers.load_corpus(spark, "", f"{tmp_path}/d").first().split == "train"


def test_prepared_data_is_checked(spark, tmp_path):
    corpus(spark).withColumn("split", F.lit("train")).write.parquet(f"{tmp_path}/p")
    assert readers.load_prepared(spark, f"{tmp_path}/p", ["split", "text"]).count() == 5
    with pytest.raises(ValueError):
        readers.load_prepared(spark, f"{tmp_path}/p", ["input_ids"])


def test_text_column(spark):
    df = corpus(spark)
    assert readers.pick_text(df) == "text"
    assert readers.pick_text(df, "body", fallback_first=True) == "k"
    with pytest.raises(ValueError):
        readers.pick_text(df, "body")


def test_publish_as_table_or_files(spark, tmp_path):
    writers.publish(corpus(spark), f"{tmp_path}/out")
    writers.publish(corpus(spark), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_small_tables_are_spread(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert readers.spread(docs, docs, "doc_id").rdd.getNumPartitions() == 16
    many = docs.repartition(20)
    assert readers.spread(many, many) is many


def test_configurations_of_a_corpus(spark, tmp_path):
    folder = str(tmp_path)
    for config, n in (("small", 2), ("big", 5)):
        for split in ("train", "test"):
            corpus(spark).where(F.col("k") < n).write.parquet(f"{folder}/{config}/{split}")
        paths = {s: f"{folder}/{config}/{s}" for s in ("train", "test")}
        readers.register_corpus(spark, folder, "org/c", paths, config)
    got = readers.load_corpus(spark, folder, "org/c", config="big")
    assert {(r.split, r.k) for r in got.collect()} == {(s, k) for s in ("train", "test") for k in range(5)}
    assert readers.load_corpus(spark, folder, "org/c", "test", "small").count() == 2
    for wrong in ({"config": "other"}, {"registered": True}, {"config": "big", "split": "dev"}):
        with pytest.raises(ValueError):
            readers.load_corpus(spark, folder, "org/c", **wrong)
    # A later entry replaces an earlier one, and a single configuration need not be named.
    readers.register_corpus(spark, folder, "one", {"train": f"{folder}/big/train"}, "x")
    readers.register_corpus(spark, folder, "one", {"train": f"{folder}/small/train"}, "x")
    assert readers.load_corpus(spark, folder, "one", registered=True).count() == 2


def test_published_versions(spark, tmp_path):
    target = f"{tmp_path}/out"
    assert writers.publish_version(corpus(spark).limit(2), target) == 1
    first = writers.read_published(spark, target)
    assert writers.publish_version(corpus(spark), target) == 2
    # A reader of the first version is not disturbed by the second.
    assert first.count() == 2 and writers.read_published(spark, target).count() == 5
    assert writers.read_published(spark, target, 1).count() == 2
    assert {(r.version, r["rows"]) for r in writers.versions(spark, target).collect()} == {(1, 2), (2, 5)}
    # A version that was written and not entered, as after a failure, is not seen and is written again.
    corpus(spark).limit(1).write.parquet(f"{target}/data/version=3")
    assert writers.read_published(spark, target).count() == 5
    assert writers.publish_version(corpus(spark).limit(3), target) == 3
    assert writers.read_published(spark, target).count() == 3
    with pytest.raises(ValueError):
        writers.read_published(spark, target, 9)


def test_csv_lines_may_be_read_in_parts(spark, tmp_path):
    path = f"{tmp_path}/train.csv"
    spark.range(50).selectExpr("id AS k", "concat('t', id) AS text").coalesce(1).write.csv(path, header=True)
    got = readers.load_files(spark, train=path, schema="k long, text string", ordered=True, multi_line=False)
    assert sorted((r.pos, r.k) for r in got.collect()) == [(k, k) for k in range(50)]


def test_written_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(scratch.CLEANUP, None)
    rows = scratch.materialise(spark.range(1000).repartition(5, "id").groupBy("id").count(), "rows")
    for _ in range(50):  # files go in the background
        if not (more := shuffled() - before):
            break
        time.sleep(0.1)
    assert not more and rows.count() == 1000 and spark.conf.get(scratch.CLEANUP, None) == setting
