"""From raw documents to token ids: toxicity, near duplicates, benchmark passages, personal data, BPE.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; ``run`` writes
each result below ``spark.checkpoint.dir`` and reads it back.

Defined results, for every stage: rows with null or repeated ids are rows of their own, except that equal
documents are near duplicates of each other; a null or empty text is clean, has no duplicates and no
personal data, and stays null or empty; texts of any length are read whole; an empty table gives an empty
table; other columns are kept, whatever their names, also those of a result such as ``toxic`` or ``spans``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, decontam, jaccard, pii, toxicity
from textloom.llm.words import bounded_batches
from textloom.sources.scratch import materialise


def hidden(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """The documents under private names, these names, and the name of each column.

    Results stand next to the columns of documents, which may have any names: ``toxic``, say.
    """
    names = [f"_kept{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names, dict(zip(docs.columns, names, strict=True))


def given_back(rows: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return rows.select(*names).toDF(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not call toxic."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    rows, names, name = hidden(docs)
    scored = toxicity.score(rows, model, text=name["text"], keep=names)
    return given_back(scored.where(~F.col("toxic")), names, docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingles at 0.8."""
    bounded_batches(spark)
    rows, names, name = hidden(docs)
    kept = jaccard.keep_first(rows, size=5, num=80, den=100, id=name["doc_id"], text=name["text"])
    return given_back(kept, names, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    bounded_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    windows = materialise(decontam.benchmark_windows(items), "benchmark")
    rows, names, name = hidden(docs)
    judged = decontam.decontaminate(rows, windows, text=name["text"], keep=names)
    return given_back(judged.where(~F.col("contaminated")), names, docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their personal data replaced by the name of its kind."""
    bounded_batches(spark)
    model = pii.fit(docs.select("doc_id", "text"))
    rows, names, name = hidden(docs)
    text, size = name["text"], name["n_chars"]
    others = [c for c in names if c not in (text, size)]
    masked = pii.find(rows, model, text=text, keep=others, mask=text)
    masked = masked.withColumn(size, F.length(text).cast("long"))
    return given_back(masked, names, docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, as digests of the ids and of the text decoded from them."""
    bounded_batches(spark)
    coder = bpe.Bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.roundtrip_digests(docs.select("doc_id", "text"), coder)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("encoding", encoding_stage),
]

# The first stages rest on trained models and on a similarity join; tests compare them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
