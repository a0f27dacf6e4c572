"""Repeated passages against all windows of all texts."""

from __future__ import annotations

import random

import numpy as np
from brute import words

from opinara.llm.hashing import hashed_words
from opinara.llm.passages import SPREAD, WORDS, anchors, repeated_passages, windows

LEAST = WORDS + SPREAD - 1


def corpus(rng):
    vocab = [f"w{k}" for k in range(3000)]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [make(n) for n in (51, 55, 80, 300)]
    texts = []
    for doc in range(40):
        parts = []
        for k, p in enumerate(passages):
            if doc % (k + 2) == 0:
                parts += [make(rng.randrange(90)), p]
        parts.append(make(rng.randrange(120)))
        flat = [w for p in parts for w in p]
        # Line ends fall anywhere, inside passages too.
        texts.append((doc, "".join(w.upper() + rng.choice([" ", " ", " ", ", ", "\n"]) for w in flat)))
    return texts


def covered(spans, doc):
    return {k for d, a, b in spans if d == doc for k in range(a, b)}


def stretches(rows, size):
    """{(doc, word)}: words inside a stretch of `size` words that some other document holds too."""
    owners = {}
    for doc, text in rows:
        w = words(text)
        for k in range(len(w) - size + 1):
            owners.setdefault(tuple(w[k : k + size]), {}).setdefault(doc, []).append(k)
    return {(d, k + j) for at in owners.values() if len(at) > 1 for d, ks in at.items() for k in ks for j in range(size)}


def test_passages_inside_and_across_lines(spark):
    rows = corpus(random.Random(1))
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = [(r.doc_id, r.from_word, r.to_word) for r in got]
    inside = {(d, k) for d, a, b in spans for k in range(a, b)}
    assert inside <= stretches(rows, WORDS)
    long = stretches(rows, LEAST)
    for doc, text in rows:
        w, mine = words(text), covered(spans, doc)
        for k in range(len(w) - LEAST + 1):
            if all((doc, k + j) in long for j in range(LEAST)):
                assert len(mine & set(range(k, k + LEAST))) >= WORDS - SPREAD
        if any(d == doc for d, _ in long):
            assert mine
    by_component = {}
    for r in got:
        by_component.setdefault((r.first_doc_id, r.first_word), []).append(r)
    for (doc, word), group in by_component.items():
        assert {r.members for r in group} == {len(group)}
        first = [r for r in group if (r.doc_id, r.from_word) == (doc, word)]
        assert len(first) == 1 and not first[0].removed and (doc, word) == min((r.doc_id, r.from_word) for r in group)
    assert {r.first_doc_id for r in got} <= {0, 3, 4, 5, 2}


def test_every_long_stretch_holds_a_window():
    rng = np.random.default_rng(3)
    shared = " ".join(f"s{k}" for k in range(LEAST))
    for k in range(200):
        texts = [f"{' '.join(f'{side}{k}x{j}' for j in range(rng.integers(0, 70)))} {shared} {' '.join(f'{side}{k}y{j}' for j in range(rng.integers(0, 70)))}".encode() for side in "ab"]
        owner, _, digest = windows(*hashed_words(texts))
        assert set(digest[owner == 0].tolist()) & set(digest[owner == 1].tolist())


def test_anchors_as_by_looking_at_each_window():
    rng = np.random.default_rng(0)
    counts = np.array([0, 3, 200, 24, 23, 90])
    values = rng.integers(0, 1 << 60, counts.sum()).astype(np.uint64)
    got = set(anchors(values, counts).tolist())
    assert got and all(np.searchsorted(np.cumsum(counts), k, "right") in (2, 3, 5) for k in got)
    low = np.cumsum(counts)[1]
    inside = sorted(k for k in got if low <= k < low + 200)
    assert max(b - a for a, b in zip(inside, inside[1:], strict=False)) <= SPREAD


def test_edge_cases(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [
        (1, passage, 1), (1, passage, 2), (2, "x\n" + passage.replace(" ", "\n") + " y", 3), (3, None, 4), (4, "", 5), (None, passage + " z", 6),
        (5, passage[:100], 7), (6, "same words " * 20_000, 8), (6, "same words " * 20_000, 9), (7, passage + " " + passage, 10),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest long")
    got = repeated_passages(df).collect()
    assert {r.doc_id for r in got} == {1, 2, 7, None} and all(r.to_word - r.from_word >= WORDS for r in got)
    assert [r.removed for r in got if r.doc_id == 1] == [False] and all(r.removed for r in got if r.doc_id in (2, None))
    assert {(r.first_doc_id, r.members) for r in got} == {(1, 5)}
    assert repeated_passages(df.limit(0)).count() == 0
    assert repeated_passages(df.where("doc_id in (3, 4)")).count() == 0
