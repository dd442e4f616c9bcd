import math
import re

import pytest
from pyspark.sql import functions as F

from textloom.operators import metrics as M


def test_perplexity_overflows_to_infinity(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 3), ("b", 800.0, 1)], "g string, nll double, n long")
    got = {r.g: r.perplexity for r in M.perplexity_by(df, "g").collect()}
    assert got["a"] == pytest.approx(math.exp(2.5))
    assert got["b"] == math.inf


def test_unigram_losses(spark):
    texts = [("en", "a b a ."), ("fr", "a c"), ("en", "d")]
    df = spark.createDataFrame(texts, "lang string, text string")
    words = [(g, w) for g, t in texts for w in re.findall(r"\w+|[^\w\s]", t)]
    counts = {}
    for _, w in words:
        counts[w] = counts.get(w, 0) + 1
    total = len(words) + len(counts)
    for r in M.unigram_losses(df, "lang").collect():
        assert r.n == words.count((r.lang, r.token))
        assert r.nll == pytest.approx(-math.log((counts[r.token] + 1) / total))


def test_sample_counts(spark):
    df = spark.createDataFrame([("train",)] * 5 + [("validation",)] * 2 + [("test",)], "split string")
    got = M.sample_counts(df, {"train": 3, "validation": 10, "test": None}).collect()
    assert {(r.split, r["rows"], r.samples) for r in got} == {
        ("train", 5, 3),
        ("validation", 2, 2),
        ("test", 1, 1),
    }


def test_corpus_size_counts_bytes(spark):
    df = spark.createDataFrame([("x", "é" * 512), ("x", "ab"), ("y", "")], "source string, text string")
    got = {r.source: (r.bytes, r.size) for r in M.corpus_size(df).collect()}
    assert got == {"x": (1026, "1.0 KB"), "y": (0, "0B")}


def test_split_summary(spark):
    df = spark.createDataFrame([("train", [1, 2]), ("train", []), ("validation", [3])], "split string, input_ids array<int>")
    got = {r.split: (r["rows"], r.tokens) for r in M.split_summary(df).collect()}
    assert got == {"train": (2, 2), "validation": (1, 1)}
