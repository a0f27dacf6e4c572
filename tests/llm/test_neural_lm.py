"""The language model: base scores, counts and normalisation exactly; learning by held-out gain."""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter

import numpy as np

from opinara.llm import neural_lm as L
from opinara.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def tokens(text):
    return re.findall(r"[^ \t\n\x0b\f\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_base_scores_and_held_out_gain(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op8_log_bilinear_lm"](spark, SF).collect()
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    count = Counter(t for d, x in texts.items() if not held(d) for t in [*tokens(x), None])
    total, distinct = sum(count.values()), len(count)
    assert len(got) == len(texts)
    for r in got:
        own = [*tokens(texts[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(t in count for t in own), total)
        assert math.isclose(r.base_score, sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in own), rel_tol=1e-9)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.05 * sum(r.n_tokens for r in out)


def test_probabilities_add_up(spark):
    text = "The cat sat on the mat and the dog sat on the cat and ran"
    docs = spark.createDataFrame([(text,)] * 30, "text string")
    table = L.token_counts(docs)
    counts = L.gathered(table, 5)
    model = L.fit(docs, counts, rounds=1, share=1.0)
    contexts = np.array([[L.END, 3, 2, 1], [0, 1, 2, 3]])
    every = [np.exp(model.log_probabilities(np.repeat(c[None], L.CLASSES, axis=0), np.arange(L.CLASSES))).sum() for c in contexts]
    assert np.allclose(every, 1, atol=1e-4)
    rows = {bytes(r.token): r.n for r in table.collect()}
    for k in range(L.SINGLE, L.END):
        mine = [n for t, n in rows.items() if t != b"\n" and t not in counts.known[: L.SINGLE] and L.shared_class(t) == k]
        assert (sum(mine), len(mine)) == (counts.class_tokens[k], counts.class_distinct[k])
    assert counts.total == sum(rows.values()) == 30 * 16 and counts.distinct == len(rows)


def test_rare_tokens_do_not_depend_on_what_tasks_know(spark):
    rows = [(k, f"common words here and rare{k % 7} unique{k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = L.F.col("doc_id") % 5 == 0
    wide = {r.doc_id: r for r in L.language_scores(docs, held).collect()}
    thin = {r.doc_id: r for r in L.language_scores(docs, held, max_known=L.SINGLE).collect()}
    assert all(wide[k].n_known == thin[k].n_known and math.isclose(wide[k].base_score, thin[k].base_score) for k in wide)


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "word " * 50_000, "x"), (4, "word " * 50_000, "x"), (None, "é É A", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = L.language_scores(docs, L.F.col("doc_id") == 3).collect()
    assert len(got) == 6 and {r.n_tokens for r in got} == {1, 50_001, 3}
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    none = L.language_scores(docs, L.F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in none)
    assert L.language_scores(docs.limit(0), L.F.lit(False)).count() == 0


def test_passes_learn_once_from_every_position(spark, monkeypatch, tmp_path):
    """No position is left out and none is learnt twice, whatever pass reads its text."""
    docs = spark.createDataFrame([(f"w{k % 7} " * (k % 5) + f"own{k}",) for k in range(300)], "text string")
    counts = L.gathered(L.token_counts(docs), 1000)
    real = L.train_batch

    def noted(model, memory, contexts, classes, *rest):
        (tmp_path / str(uuid.uuid4())).write_text(" ".join(map(str, classes.tolist())))
        return real(model, memory, contexts, classes, *rest)

    monkeypatch.setattr(L, "train_batch", noted)
    L.fit(docs, counts)
    learnt = Counter(int(c) for p in tmp_path.iterdir() for c in p.read_text().split())
    assert learnt == Counter({k: int(n) for k, n in enumerate(counts.class_tokens) if n})


def test_rows_are_added_by_class():
    rng = np.random.default_rng(3)
    classes, rows = rng.integers(0, 9, 500), rng.normal(size=(500, 4))
    got, want = np.zeros((9, 4)), np.zeros((9, 4))
    L._add_rows(got, classes, rows)
    np.add.at(want, classes, rows)
    assert np.allclose(got, want)
