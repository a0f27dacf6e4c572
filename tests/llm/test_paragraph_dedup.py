"""Paragraph MinHash against the exact similarity of all pairs."""

from __future__ import annotations

import random

import pytest
from brute import classes, runs, words

from opinara.llm.paragraph_dedup import repeated_paragraphs, tuned_bands, without_repeated_paragraphs

SF = "/root/testdata/sf0.001"


def expected(rows):
    places = [(d, no, p) for d, t in rows for no, p in enumerate(t.split("\n")) if len(words(p)) >= 40]
    sets = [set(runs(p)) for _, _, p in places]
    n = range(len(places))
    top = classes(n, [(a, b) for a in n for b in n if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    groups = {}
    for k in n:
        groups.setdefault(top[k], []).append(places[k][:2])
    return {p: (min(g), len(g)) for g in groups.values() if len(g) > 1 for p in g}


def found(df):
    rows = repeated_paragraphs(df).collect()
    assert all(r.removed == ((r.doc_id, r.paragraph) != (r.first_doc_id, r.first_paragraph)) for r in rows)
    return {(r.doc_id, r.paragraph): ((r.first_doc_id, r.first_paragraph), r.members) for r in rows}


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_hot_passages_and_families(spark, monkeypatch):
    monkeypatch.setattr("opinara.llm.linking.BLOCK", 8)
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(2000)]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    hot, source, half = make(55), make(90), make(30)
    rows = []
    for doc in range(80):
        copy = list(source)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(90)] = rng.choice(vocab)
        paragraphs = [make(45), hot, copy if doc % 2 else make(30), half + make(25)]
        rows.append((doc, "\n".join(" ".join(p) for p in paragraphs)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


@pytest.mark.parametrize(("least", "miss"), [(0.8, 4e-3), (0.8, 1e-4), (0.5, 1e-3)])
def test_bands_keep_the_recall(least, miss):
    bands, rows = tuned_bands(least, miss)
    assert (1 - least**rows) ** bands <= miss and bands * rows <= 72


PASSAGE = " ".join(f"word{k}" for k in range(60))
EDGE = [(1, PASSAGE, "x"), (1, PASSAGE, "x"), (2, f"short\n{PASSAGE.upper()}\nend", "x"), (3, None, "x"), (4, "", "x"), (None, PASSAGE, "x"), (5, "same words " * 50_000, "x"), (6, "same words " * 50_001, "x"), (7, PASSAGE[:200], "x")]


def test_edge_cases(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, paragraph string")
    got = sorted([(r.doc_id, r.paragraph, r.first_doc_id, r.members, r.removed) for r in repeated_paragraphs(df).collect()], key=str)
    want = [(1, 0, 1, 3, False), (2, 1, 1, 3, True), (None, 0, 1, 3, True), (5, 0, 5, 2, False), (6, 0, 5, 2, True)]
    assert got == sorted(want, key=str)
    left = without_repeated_paragraphs(df)
    assert left.columns == df.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[2] == "short\nend" and texts[1] == PASSAGE and texts[3] is None and texts[None] == "" and texts[7] == PASSAGE[:200]
    assert repeated_paragraphs(df.limit(0)).count() == 0


def test_one_set_of_runs_told_at_different_lengths(spark):
    """A paragraph that repeats its 50 words twice and one that does so ten times have the same runs."""
    cycle = " ".join(f"c{k}" for k in range(50))
    rows = [(1, " ".join([cycle] * 2)), (2, " ".join([cycle] * 10))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows) != {}


def test_a_clashing_column_stays(spark):
    df = spark.createDataFrame([(1, PASSAGE, "a", "b"), (2, PASSAGE, "c", None)], "doc_id long, text string, gone string, row string")
    assert [(r.text, r.gone, r.row) for r in without_repeated_paragraphs(df).orderBy("doc_id").collect()] == [(PASSAGE, "a", "b"), ("", "c", None)]
