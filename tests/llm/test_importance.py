from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import words

from opinara.llm import importance as im
from opinara.llm.importance import crc_by_length, drawn, importance


def plain(docs, target, sizes=(1, 1), buckets=10_000, percent=10, least=20):
    def features(text):
        w = words(text)
        grams = [" ".join(w[k : k + n]) for n in range(sizes[0], sizes[1] + 1) for k in range(len(w) - n + 1)]
        return [zlib.crc32(g.encode()) % buckets for g in grams]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    ns, nt = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for doc, text in docs:
        f = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * ns / ((s[b] + 1) * nt))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = Counter()
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        rank[r, k + 1] += 1
    for r in fit[percent * len(fit) // 100 :] + [r for r in rows if r[1] < least]:
        rank[r, None] += 1
    return rank


def corpus():
    docs = [(k, " ".join(f"w{(k * j * j + j) % (30 + k % 70)}" for j in range(k % 90))) for k in range(300)]
    return docs + [(7, docs[55][1])] * 40 + [(None, "Été " * 25), (None, None), (900, ""), (901, "a-b " * 30_000), (902, "x" * 3000)]


def run(spark, docs, target, parts=5, **options):
    d = spark.createDataFrame([(*x, "r", 1) for x in docs], "doc_id long, text string, row string, score int").repartition(parts)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    pick = {k: options.pop(k) for k in ("percent", "least_words") if k in options}
    scored = importance(d, t, **options)
    assert scored.columns == ["doc_id", "text", "row", "score", "importance"]
    out = drawn(scored.select("doc_id", "row", "importance"), **pick)
    assert out.columns == ["doc_id", "row", "importance"]
    fields = ["n_words", "n_features", "weight", "score"]
    return Counter(((r["doc_id"], *[r["importance"][c] for c in fields]), r["importance"]["rank"]) for r in out.collect())


TARGET = ["w1 w2 w3 w4 Été", None, "", "w5 w1"]


@pytest.mark.parametrize("sizes", [(1, 1), (1, 2), (3, 3)])
def test_as_by_plain_counting(spark, sizes):
    assert run(spark, corpus(), TARGET, sizes=sizes) == plain(corpus(), TARGET, sizes)


def test_partitions_and_parts_do_not_matter(spark, monkeypatch):
    want = run(spark, corpus(), TARGET, parts=1)
    assert run(spark, corpus(), TARGET, parts=23) == want
    assert run(spark, corpus(), TARGET, percent=100, least_words=0) == plain(corpus(), TARGET, percent=100, least=0)


def test_features_across_the_parts_of_a_long_text(monkeypatch):
    texts = [("ab c  déf gh " * 50).encode(), b"", b"one", ("q" * 90 + " r s").encode()]
    for piece in (7, 40, 1 << 19):
        monkeypatch.setattr(im, "_PIECE", piece)
        got = [Counter() for _ in texts]
        for units in im._grouped(texts, 2):
            _, owner, bucket = im._buckets(units, (2, 3), 10_000)
            for o, b in zip(owner.tolist(), bucket.tolist(), strict=True):
                got[o][b] += 1
        for text, counted in zip(texts, got, strict=True):
            w = text.decode().split()
            want = Counter(zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000 for n in (2, 3) for k in range(len(w) - n + 1))
            assert counted == want


def test_crc_of_many_lengths():
    strings = [bytes((k * j) % 256 for j in range(k)) for k in [*range(70), 1024, 1025, 4000]] * 2
    data = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings])
    found = crc_by_length(data, np.cumsum(lengths) - lengths, lengths)
    assert found.tolist() == [zlib.crc32(s) for s in strings]


def test_empty_tables(spark):
    assert run(spark, [], TARGET) == Counter()
    assert run(spark, corpus()[:50], []) == plain(corpus()[:50], [])
    assert run(spark, [(1, None), (2, "")], TARGET) == plain([(1, None), (2, "")], TARGET)

