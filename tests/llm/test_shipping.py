"""Models reach tasks that cannot import the package."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from opinara.session import local_session
from pyspark.sql import functions as F
from opinara.llm.neural_lm import language_scores
from opinara.llm.toxicity import toxicity, train
spark = local_session("2", partitions=2, memory="2g")
docs = spark.createDataFrame([(k, "good day" if k % 2 else "bad night", "en") for k in range(40)], "doc_id long, text string, lang string")
labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
assert toxicity(docs, train(docs, labels)).where("toxicity between 0 and 1").count() == 40
assert language_scores(docs.select("doc_id", "text"), F.col("doc_id") % 5 == 0).where("score < 0").count() == 40
print("shipped")
"""


def test_models_are_sent_by_value(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600, check=False)
    assert "shipped" in run.stdout, run.stderr[-2000:]
