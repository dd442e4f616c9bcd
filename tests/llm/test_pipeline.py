"""The registered queries and the pipeline, over whole small tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import oracle
from textloom.llm import jaccard, queries


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir).cache()
        assert after.select("doc_id").distinct().count() == after.count() <= before.count(), name
        if name != "encoding":
            assert after.columns == columns and after.count() > 0.7 * before.count(), name
        if name == "near_duplicates":
            found = jaccard.join_components(before, 5, 80, 100)
            assert after.count() == found.select("component").distinct().count()
        if name == "personal_data":
            assert after.where(F.col("text").rlike("[a-z0-9]@[a-z0-9]+[.]")).count() == 0
        before = after


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_table(spark, sf_dir, name):
    source = "pages" if name.split("_")[0] in ("op2", "op3", "op7") else "documents"
    rows = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    if name.startswith("op12"):
        rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct()
    df = queries.QUERIES[name](spark, sf_dir)
    assert df.count() == rows.count()
    if name in queries.ORACLES:
        assert oracle.actual(df) == oracle.expected(oracle.connect(sf_dir), queries.ORACLES[name])


CLASHING = ["toxic", "severity", "n_hits", "item_id", "contaminated", "spans", "n_email", "_gone", "_read", "id", "_k0", "_kept1"]


def odd_documents(spark, sf_dir, rows=None):
    """Nulls in every column, empty and very long texts, repeated rows and ids, and clashing names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    base = [tuple(r) for r in docs.orderBy("doc_id").limit(20).collect()]
    long = " ".join(f"w{k} mail{k}@example.com" for k in range(20_000))
    odd = [(None, None, None, None, None), (None, "alone and without an id, yet a text of its own", "en", "x", 1)]
    odd += [(900, "", "en", "x", 0), (901, " \n\t ", "en", "x", 4), (902, None, "en", "x", None), (903, long, "en", "x", len(long))]
    odd += [base[0]] * 3 + [(base[1][0], "another text under an id that is taken already", "en", "x", 1)]
    every = [(*r, *(f"{c}!" for c in CLASHING)) for r in (base + odd if rows is None else rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(every, schema).repartition(3)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_any_table(spark, sf_dir, name, stage):
    docs = odd_documents(spark, sf_dir)
    after = stage(spark, docs, sf_dir).cache()
    empty = stage(spark, odd_documents(spark, sf_dir, rows=[]), sf_dir)
    assert empty.count() == 0 and empty.columns == after.columns
    if name == "encoding":
        assert after.count() == docs.count()
        return
    assert after.columns == docs.columns
    rows = after.collect()
    assert all(r[c] == f"{c}!" for r in rows for c in CLASHING)
    # Equal rows are near duplicates of each other; nothing else here is dropped for what it is.
    clean = [r for r in rows if r.doc_id in (900, 901, 902, 903) or r.doc_id is None]
    assert len(clean) == 6
    assert sum(r.text == "another text under an id that is taken already" for r in rows) == 1
    assert {r.text for r in rows if r.doc_id in (900, 902)} == {"", None}
    if name == "personal_data":
        assert "example.com" not in next(r.text for r in rows if r.doc_id == 903)
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
