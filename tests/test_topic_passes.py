"""What the passes of a topic model leave on disk and move."""

from __future__ import annotations

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from opinara import session
from opinara.operators import lda, topics
from opinara.operators.lda import fit_topics
from opinara.session import discard, saved


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_root", lambda _: str(tmp_path))
    return tmp_path


def corpus(spark, n=60):
    rows = [(i, "AB"[i % 2], [f"w{(i * j) % 11}" for j in range(i % 7 + 1)] + [f"own{i}"]) for i in range(n)]
    return spark.createDataFrame(rows, "id int, app string, tokens array<string>")


def test_one_table_of_word_topics_is_left(spark, folder):
    models = fit_topics(corpus(spark), "tokens", "id", ["app"], ks=[2], passes=4, block_rows=10)
    assert len(glob.glob(str(folder / "word-topics-*"))) == 1
    assert not glob.glob(str(folder / "bags-*"))
    assert models.top_words(3).count() == 12 and models.probabilities(2).count() == 60


def test_a_row_of_the_table_lists_the_blocks_of_its_word(spark, folder):
    models = fit_topics(corpus(spark), "tokens", "id", ["app"], ks=[2, 3], passes=2, block_rows=10)
    listed = {r["_id"]: sorted(r["_blocks"]) for r in models.state.collect()}
    needed = {}
    for r in models.needed.collect():
        needed.setdefault(r["_id"], []).append(r["_block"])
    assert listed == {i: sorted(b) for i, b in needed.items()}
    plan = lda._expected(models.state, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_sums_do_not_depend_on_lots(spark, folder, monkeypatch):
    def weights(cells):
        monkeypatch.setattr(lda, "_LOT_CELLS", cells)
        models = fit_topics(corpus(spark), "tokens", "id", ["app"], ks=[3], passes=3, block_rows=10)
        return {(r["app"], r["word"]): [r[f"l{j}"] for j in range(3)] for r in models.words.collect()}

    few, many = weights(1 << 19), weights(16)
    assert few.keys() == many.keys()
    assert all(few[w] == pytest.approx(many[w]) for w in few)


def test_shuffled_files_go_with_the_table(spark, folder):
    place = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = place.getAllFiles().mkString("\n").split("\n")
        return {os.path.basename(x) for x in names if os.path.basename(x).startswith("shuffle_")}

    counts = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    before = shuffled()
    out = saved(counts, "counts")
    mine = shuffled() - before
    assert mine and out.count() == 7
    discard(out)
    for _ in range(50):
        if not shuffled() & mine:
            break
        time.sleep(0.2)
    assert not shuffled() & mine
    assert not glob.glob(str(folder / "counts-*"))


def test_topic_rows_hold_what_the_table_needs(spark, folder, monkeypatch):
    kept = []
    write = topics.saved
    monkeypatch.setattr(topics, "saved", lambda df, name: kept.append((name, df.columns)) or write(df, name))
    rows = [(f"r{i}", "A", "positive", f"word{i % 5} other{i % 3} last", 9) for i in range(30)]
    df = spark.createDataFrame(rows, "reviewId string, app string, sentiment string, texto_limpio string, word_count int")
    table = topics.topic_table(df, [("A", "positive")], topics.topic_names(spark), k=4, n_init=1, passes=1)
    assert table.count() == 30 and "word_count" not in table.columns
    assert all("word_count" not in columns for _, columns in kept)
    assert all("_tokens" not in columns for name, columns in kept if name == "segment-features")
