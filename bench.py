"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the cores and ``BENCH_RUNS`` the runs per
query after one warm-up.  Times are medians in seconds of preparing plus running a query; every
query writes to a sink that takes all columns, so that nothing is pruned away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textloom.plans import corpus, registry as R  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "build_vocab",
    "tokenize_docs",
    "group_texts",
    "group_texts_whole",
    "head_percent_split",
    "global_position",
    "pack_dialogs",
    "chat_samples",
    "response_mask",
    "dialog_from_transcript",
    "perplexity_by_lang",
    "corpus_size",
]


def blocks_2048(spark: SparkSession, sf: str) -> DataFrame:
    """The baseline's own setting: blocks of 2048 tokens from batches of 1000 rows."""
    vocab = R.full_vocab(spark, sf)
    return corpus.prepare_corpus(R.documents(spark, sf), vocab, block_size=2048, batch_size=1000)


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: R.QUERIES[name] for name in HEADLINE}
    queries["group_texts_2048"] = blocks_2048
    names = sys.argv[1:] or list(queries)
    times, plans = {}, {}
    for name in names:
        runs, prepared = [], []
        query = queries.get(name) or R.QUERIES[name]
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            df = query(spark, SF_DIR)
            planned = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            prepared.append(planned - start)
        times[name] = round(statistics.median(runs[1:]), 3)
        plans[name] = round(statistics.median(prepared[1:]), 3)
    result = {
        "metric": "total warm median time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "prepare": plans,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
