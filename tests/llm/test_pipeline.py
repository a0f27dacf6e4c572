"""Every pipeline stage against a plain version on its own input, and the decontamination operator's edges."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import test_line_dedup
import test_mixing
import test_order_minhash
from brute import words

import corpus_pipeline
from opinara.llm import toxicity as T
from opinara.llm.contamination import contamination

SF = "/root/testdata/sf0.001"


def windows(text, size=10):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def hit_words(text, cuts):
    w, hit = words(text), set()
    for cut in cuts:
        for k in range(len(w) - len(cut) + 1):
            if tuple(w[k : k + len(cut)]) == cut:
                hit.update(range(k, k + len(cut)))
    return hit


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        before = [(r.doc_id, r.text) for r in docs.collect()]
        sources = {r.doc_id: r.source for r in docs.collect()}
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        if k < 4:
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in rows}
            assert len(after) == len(rows) > 0.5 * len(before)
        if k == 0:
            model = T.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
            kept = {d: t for d, t in before if T.score(model, T.word_rows([t.encode()]))[0] < 0.5}
            assert not model.thresholds and after == kept
        if k == 1:
            gone = test_line_dedup.expected(before)
            want = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(d, ())) for d, t in before}
            assert after == {d: t for d, t in want.items() if d not in gone or re.search(r"[^\W_]", t)}
            assert all(r.n_chars == len(r.text) for r in rows if r.doc_id in gone)
        if k == 2:
            assert set(after) == set(test_order_minhash.expected(before).values())
        if k == 3:
            cuts = set().union(*[windows(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
            assert set(after) == {d for d, t in before if not hit_words(t, cuts)}
        if k == 4:
            want = test_mixing.expected([(d, sources[d], t) for d, t in before], 0.97, 4.0)
            assert Counter((r.doc_id, r.source, r.copy) for r in rows) == want


def test_contamination_edges(spark, monkeypatch):
    ten = " ".join(f"w{k}" for k in range(12))
    bench = [(1, ten), (2, "Short ITEM"), (2, None), (3, ""), (None, "no id here"), (4, ten)]
    docs = [
        (1, f"é {ten.upper()}!! and short, item.", 0), (2, " ".join(f"w{k}" for k in range(9)), 0), (3, None, 0), (4, "", 0),
        (5, "no-id-here", 0), (5, "no-id-here", 0), (None, "x " * 100_000 + "short item", 0), (6, "shortitem", 0),
    ]
    b = spark.createDataFrame(bench, "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string, contamination int")
    for most in (200_000, 2):
        got = contamination(d, b, max_windows=most).collect()
        assert len(got) == len(docs)
        by = {r.doc_id: r.contamination for r in got}
        assert (by[1].n_words, by[1].n_hit, by[1]["items"]) == (16, 14, [1, 2, 4])
        text = docs[0][1]
        assert [text[s["from"] : s.to] for s in by[1].spans] == [ten.upper(), "short, item"]
        assert by[2].n_hit == by[3].n_words == by[4].n_words == by[6].n_hit == 0
        assert (by[5].n_hit, by[5]["items"]) == (3, []) and (by[None].n_words, by[None].n_hit) == (100_002, 2)
    assert contamination(d.limit(0), b).count() == 0
    assert all(r.contamination.n_hit == 0 for r in contamination(d, b.limit(0)).collect())
    assert np.all([r.contamination.n_hit >= 0 for r in contamination(d, b, size=1).collect()])
