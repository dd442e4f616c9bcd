import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from textloom.operators.tokens import tokenize
from textloom.operators.vocab import Vocabulary, build_vocab
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("train", 0, "a b a")], "split string, pos long, text string")
print("IDS", tokenize(df, Vocabulary(build_vocab(df))).first().input_ids)
"""


def test_workers_do_not_need_the_package(tmp_path):
    """Run from another folder, where no worker could import it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)],
        cwd=tmp_path, capture_output=True, text=True, timeout=300,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert "IDS [3, 4, 3]" in done.stdout, done.stderr[-2000:]
