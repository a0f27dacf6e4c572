"""The text classifier: held-out accuracy, whole texts, independence of other columns."""

from __future__ import annotations

import zlib

import numpy as np

from opinara.llm import toxicity as T
from opinara.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_toxicity_cnn"](spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good = [s for s, y in held if y == 1]
    clean = [s for s, y in held if y == 0]
    auc = np.mean([[(a > b) + (a == b) / 2 for b in clean] for a in good])
    assert auc > 0.95
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95


def small_model():
    texts = [b"you are bad bad people %d" % k for k in range(40)] + [b"you are kind good people %d" % k for k in range(40)]
    return T.fit(T.word_rows(texts), np.array([1] * 40 + [0] * 40), ["en"] * 80)


def test_whole_texts_and_edges(spark):
    model = small_model()
    filler = "good people are kind " * 40_000
    rows = [(1, filler, "x"), (2, filler + " bad bad", "x"), (3, None, "x"), (4, "", "x"), (5, "bad bad", "x"), (5, "bad bad", None), (None, "!!", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxicity string")
    got = T.toxicity(df, model).collect()
    by = {r.doc_id: r.toxicity for r in got}
    assert len(got) == 7 and by[2] > 0.5 > by[1] and by[5] > 0.5 and by[3] == by[4] == by[None]
    assert T.toxicity(df.limit(0), model).count() == 0


def test_pieces_of_long_texts_change_nothing(monkeypatch):
    model = small_model()
    rows = T.word_rows([b"kind people are good bad people and more words " * 30, b"", b"bad"])
    whole = T.largest(model, rows)
    monkeypatch.setattr(T, "_TOKENS_AT_ONCE", 7)
    assert np.allclose(whole, T.largest(model, rows), atol=1e-5)


def test_missing_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, None), (None, "c", "en")], "doc_id long, text string, lang string")
    labels = lambda *rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    assert np.allclose(T.score(T.train(docs, labels((1, None), (2, 5), (None, 1), (9, 1))), T.word_rows([b"a", b""])), 0.5)
    assert (T.score(T.train(docs, labels((1, 1), (2, 1))), T.word_rows([b"x"])) > 0.9).all()
