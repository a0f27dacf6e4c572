"""Order MinHash classes against all pairs, and its parts against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import classes, lcs, runs, words

from opinara.llm.alignment import banded_lcs
from opinara.llm.components import components
from opinara.llm.hashing import hashed_words
from opinara.llm.order_minhash import deduplicated, near_duplicates

SF = "/root/testdata/sf0.001"


def expected(rows, least=0.8):
    """Classes by aligning all pairs."""
    seq = {k: runs(t) for k, (_, t) in enumerate(rows)}
    links = []
    for a in seq:
        for b in seq:
            n, m = len(seq[a]), len(seq[b])
            if a < b and n and m and min(n, m) >= least * max(n, m) and len(set(seq[a]) & set(seq[b])) * 3 > min(n, m):
                same = lcs(seq[a], seq[b])
                if same >= least * (n + m - same):
                    links.append((a, b))
    top = classes(seq, links)
    smallest: dict = {}
    for k, (doc, _) in enumerate(rows):
        smallest[top[k]] = min(smallest.get(top[k], doc), doc)
    return {doc: smallest[top[k]] for k, (doc, _) in enumerate(rows)}


@pytest.mark.parametrize("seed", range(3))
def test_banded_lcs(seed):
    rng = random.Random(seed)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(40))]
        b = [x for x in a if rng.random() < 0.9] + [rng.randrange(6) for _ in range(rng.randrange(4))]
        band = rng.randrange(30)
        true, got = lcs(a, b), banded_lcs(a, b, band)
        assert got <= true
        if len(a) + len(b) - 2 * true <= band:
            assert got == true


def test_words_hash_alike_wherever_they_stand():
    texts = ["The cat sat. THE-cat Été", "", "été the", "...", "x" * 3_000_000 + " the " + "ab " * 900_000]
    found, counts = hashed_words([t.encode() for t in texts])
    flat = [w for t in texts for w in words(t)]
    assert counts.tolist() == [len(words(t)) for t in texts]
    by_word = {}
    for w, h in zip(flat, found.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("part", [200_000, 90])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr("opinara.llm.components.PART_EDGES", part)
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    edges += [(2000, k) for k in range(2001, 2300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    want = classes({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k in got} and all(k == v for k, v in want.items() if k not in got)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows)
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert got == want


def families():
    rng = random.Random(1)
    vocab = [f"w{k}" for k in range(3000)]
    out, doc = [], 0
    shared = " ".join(rng.choice(vocab) for _ in range(40))
    for family in range(6):
        source = [rng.choice(vocab) for _ in range(220)]
        for _ in range(1 if family == 0 else 25):
            copy = list(source)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append((doc, " ".join(copy)))
            doc += 1
    for _ in range(60):
        out.append((doc, shared + " " + " ".join(rng.choice(vocab) for _ in range(60))))
        doc += 1
    return out


def test_families_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr("opinara.llm.linking.BLOCK", 16)
    rows = families()
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected(rows)


EDGE = [
    (1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (2, "A b, c d e F g!", "x"), (3, None, "x"), (4, "", "x"), (5, "...", "x"),
    (6, "one two", "x"), (7, "One two", "x"), (8, "two one", "x"), (None, "one two", "x"), (None, "lone text here", "x"),
    (9, "z " * 60_000, "x"), (10, "z " * 60_001, "x"), (None, "no id", "x"), (None, "No id", "x"),
]


def test_edge_cases(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, class_id string")
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert len(got) == len(EDGE)
    by = {d: (c, k) for d, c, k in got if d is not None}
    assert by == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True), 5: (5, True), 6: (6, True), 7: (6, False), 8: (8, True), 9: (9, True), 10: (9, False)}
    left = deduplicated(df)
    assert left.columns == df.columns
    texts = sorted(str(r.text)[:9] for r in left.collect())
    assert texts == sorted(["a b c d e", "None", "", "...", "one two", "two one", "lone text", ("z " * 5)[:9], "no id"]) or "No id" in texts
    assert near_duplicates(df.limit(0)).count() == 0 and deduplicated(df.limit(0)).count() == 0
