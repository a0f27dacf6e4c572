from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm.grammar import rounds
from opinara.llm.queries import with_planted_runs
from opinara.llm.word_runs import find_runs, word_runs


def plain_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences(rng, kind):
    n = rng.randint(0, 150)
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    if kind == "periodic" and n:
        a, p = rng.randrange(n), rng.randint(1, 20)
        words = [words[min(n - 1, a + (i - a) % p)] if i >= a else w for i, w in enumerate(words)]
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        words = b[:n]
    return words


@pytest.mark.parametrize("kind", ["random", "periodic", "fibonacci"])
@pytest.mark.parametrize("least", [1, 5, 12, 30])
def test_runs_as_by_trying_every_period(kind, least):
    rng = random.Random(least)
    for _ in range(60):
        docs = [sequences(rng, kind) for _ in range(rng.randint(1, 4))]
        docs.append(list(docs[0]))
        want, at = [], 0
        for d in docs:
            want += [(s + at, n, q) for s, n, q in plain_runs(d, least)]
            at += len(d)
        tokens = np.array([w for d in docs for w in d], np.int64)
        found = find_runs(tokens, np.array([len(d) for d in docs]), least)
        assert list(zip(*[x.tolist() for x in found], strict=True)) == want


def test_each_rule_derives_the_same_tokens_at_all_its_places():
    rng = random.Random(1)
    tokens = np.array([rng.randrange(3) for _ in range(2000)])
    sizes = np.array([500, 0, 1, 1499])
    heads, covered = set(), np.zeros(len(tokens), int)
    for rules in rounds(tokens, sizes):
        for rule, at in zip(rules.rule, rules.at, strict=True):
            size, first = rules.left[rule] + rules.right[rule], rules.first[rule]
            assert (tokens[at : at + size] == tokens[first : first + size]).all()
            assert at + size <= 500 or at >= 501
            covered[at : at + size] += 1
        heads |= set(rules.at.tolist())
    assert covered[501:].min() > 0 and 500 not in heads


def test_repeats_are_searched_once():
    tokens = np.tile(np.arange(5000) % 977, 8)
    n_rules = sum(len(r.left) for r in rounds(tokens, np.array([len(tokens)])))
    assert n_rules < 1100


def test_long_runs_of_one_word():
    found = find_runs(np.zeros(30_000, np.int64), np.array([10_000, 20_000]))
    assert [x.tolist() for x in found] == [[0, 10_000], [10_000, 20_000], [1, 1]]


def test_odd_rows(spark):
    again = " ".join(["a", "b", "c"] * 5)
    rows = [
        (1, None, "r", "x"), (2, "", "r", "x"), (3, " \n\t ", "r", "x"), (4, again, "r", "x"), (4, again, "r", "x"),
        (None, f"start {again} end", "r", "x"), (6, "é " * 40, "r", "x"), (7, "\u00a0 " * 12, "r", None), (8, "w", "r", "x"),
        (9, "lorem\x0bipsum dolor\x0c" * 6, "r", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, word_runs string")
    found = word_runs(docs)
    assert found.columns == ["doc_id", "text", "row", "word_runs"]
    got = sorted([(r["text"], r["word_runs"]) for r in found.collect()], key=str)
    want = []
    for _, text, _, _ in rows:
        words = (text or "").encode().split()
        runs = plain_runs(words)
        want.append((text, (len(words), [tuple(r) for r in runs], plain_collapsed([w.decode() for w in words], runs))))
    assert sorted(((t, (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])) for t, r in got), key=str) == sorted(want, key=str)
    assert word_runs(docs.where("false")).collect() == []


def test_planted_documents(spark):
    rows = [(k, " ".join(f"w{(k * i * i) % 97}" for i in range(k % 61))) for k in range(300)] + [(None, "a b"), (5, None)]
    got = with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for (doc, text), row in zip(rows, got, strict=True):
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        words, g = (text or "").split(), h // 10
        if h % 10 == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            text = " ".join(words[i if i < a else a + (i - a) % p] for i in range(len(words)))
        assert row["text"] == text


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "x y " * (k % 20) + "z " * k) for k in range(40)], "doc_id long, text string")
    whole = sorted(map(str, word_runs(docs.coalesce(1)).collect()))
    assert sorted(map(str, word_runs(docs.repartition(7)).select(*[F.col(c) for c in docs.columns], "word_runs").collect())) == whole
