"""Multi-start K-Means, partitioned LDA and coherence against plain versions."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import centroids, coherence, lda, topics
from opinara.operators.centroids import fit_clusters
from opinara.operators.lda import digamma, fit_topics

KEYS = ["app", "sentiment"]


def corpus(spark, n=120, seed=3):
    rng = random.Random(seed)
    themes = {"x": ["sun", "sea", "sand", "beach"], "y": ["code", "bug", "test", "crash"]}
    rows = []
    for i in range(n):
        app, theme = "AB"[i % 2], "xy"[i // 2 % 2]
        words = [rng.choice(themes[theme]) for _ in range(rng.randint(0, 30))] + [f"only{app}"]
        rows.append((i, app, "s", theme, " ".join(words)))
    df = spark.createDataFrame(rows, "id int, app string, sentiment string, theme string, text string")
    return df.withColumn("tokens", F.filter(F.split("text", " "), lambda w: w != ""))


def test_digamma():
    x = np.array([0.01, 0.25, 1.0, 3.5, 100.0, 1e6])
    step = 1e-5 * x
    slope = [(math.lgamma(a + h) - math.lgamma(a - h)) / (2 * h) for a, h in zip(x, step, strict=True)]
    assert digamma(x) == pytest.approx(slope, rel=1e-5)


def test_segment_features(spark):
    df = corpus(spark)
    out, terms = topics.segment_features(df, "text", KEYS, max_features=4, stop_words=["sea"])
    assert set(terms) == {("A", "s"), ("B", "s")} and all(len(t) == 4 and "sea" not in t and t == sorted(t) for t in terms.values())
    rows = out.collect()
    for key, names in terms.items():
        mine = [r for r in rows if r["app"] == key[0]]
        n_docs = len(mine)
        df_of = {t: sum(t in r["tokens"] for r in mine) for t in names}
        total = Counter(w for r in mine for w in r["tokens"] if w != "sea")
        assert set(names) == {w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:4]}
        for r in mine:
            raw = {names.index(t): r["tokens"].count(t) * (math.log((1 + n_docs) / (1 + df_of[t])) + 1) for t in names if t in r["tokens"]}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            got = dict(zip(r["features"]["indices"], r["features"]["values"], strict=True))
            assert got == pytest.approx({i: v / norm for i, v in raw.items()})


def dense(rows, dim):
    x = np.zeros((len(rows), dim))
    for k, r in enumerate(rows):
        x[k, r["features"]["indices"]] = r["features"]["values"]
    return x


def test_all_starts_and_counts_in_one_fit(spark):
    df, _ = topics.segment_features(corpus(spark), "text", KEYS, max_features=20)
    df = df.cache()
    fitted = fit_clusters(df, "id", 20, KEYS, ks=[1, 2, 5], n_init=4)
    assert len(fitted.centroids) == 2 * 3 * 4
    for segment in [("A", "s"), ("B", "s")]:
        rows = df.where((F.col("app") == segment[0])).collect()
        x = dense(rows, 20)
        for (s, k, start), c in fitted.centroids.items():
            if s != segment:
                continue
            d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
            assert fitted.inertia[s, k, start] == pytest.approx(d.min(axis=1).sum(), abs=1e-9)
            near = d.argmin(axis=1)
            for j in set(near.tolist()):
                assert c[j] == pytest.approx(x[near == j].mean(axis=0), abs=1e-3)
    assert fitted.elbow() == [
        (*s, k, min(v for key, v in fitted.inertia.items() if key[:2] == (s, k))) for s in [("A", "s"), ("B", "s")] for k in (1, 2, 5)
    ]
    given = df.select("app", "theme", fitted.assign(F.col("features"), 2).alias("c")).collect()
    assert all(len({(r["theme"], r["c"]) for r in given if r["app"] == a}) <= 4 for a in "AB")
    again = fit_clusters(df.repartition(5), "id", 20, KEYS, ks=[1, 2, 5], n_init=4)
    assert all(again.inertia[key] == pytest.approx(v, abs=1e-6) for key, v in fitted.inertia.items())


def test_fewer_rows_than_clusters(spark):
    df, _ = topics.segment_features(corpus(spark).where("id < 4"), "text", KEYS, max_features=20)
    fitted = fit_clusters(df.where("app = 'A'"), "id", 20, KEYS, ks=[5], n_init=2)
    assert max(fitted.inertia.values()) == pytest.approx(0, abs=1e-9)
    assert df.select(fitted.assign(F.col("features"), 5).alias("c"), "app").where("app = 'B' and c is not null").count() == 0


def plain_lda(docs, k, first, passes, steps=20):
    words = sorted({w for d in docs for w in d})
    lam = {w: list(first[w]) for w in words}
    for _ in range(passes):
        total = [sum(lam[w][t] for w in words) for t in range(k)]
        beta = {w: [math.exp(float(digamma(np.array([lam[w][t]]))[0] - digamma(np.array([total[t]]))[0])) for t in range(k)] for w in words}
        new = {w: [1 / k] * k for w in words}
        for d in docs:
            if not d:
                continue
            bag = Counter(d)
            gamma = [1 / k + len(d) / k] * k
            for _ in range(steps):
                g = np.exp(digamma(np.array(gamma)) - digamma(np.array([sum(gamma)])))
                share = {w: np.array(beta[w]) * g / (np.array(beta[w]) @ g) * n for w, n in bag.items()}
                gamma = [1 / k + sum(s[t] for s in share.values()) for t in range(k)]
            for w, s in share.items():
                new[w] = [a + b for a, b in zip(new[w], s, strict=True)]
        lam = new
    return lam


def test_lda_as_one_model_at_a_time(spark):
    df = corpus(spark, 60)
    started = fit_topics(df, "tokens", "id", KEYS, ks=[2, 3], passes=0)
    fitted = fit_topics(df, "tokens", "id", KEYS, ks=[2, 3], passes=3, block_rows=7)
    whole = fit_topics(df.repartition(3), "tokens", "id", KEYS, ks=[2, 3], passes=3)
    first = {(r["app"], r["word"]): r for r in started.words.collect()}
    after = {(r["app"], r["word"]): r for r in fitted.words.collect()}
    other = {(r["app"], r["word"]): r for r in whole.words.collect()}
    for app in "AB":
        docs = [r["tokens"] for r in df.where(F.col("app") == app).collect()]
        for k in (2, 3):
            cols = [f"l{j}" for j in fitted.columns(k)]
            want = plain_lda(docs, k, {w: [r[c] for c in cols] for (a, w), r in first.items() if a == app}, 3)
            assert {w for a, w in after if a == app} == set(want)
            for w, v in want.items():
                assert [after[app, w][c] for c in cols] == pytest.approx(v, rel=1e-6)
                assert [other[app, w][c] for c in cols] == pytest.approx(v, rel=1e-6)


def test_lda_parts_two_themes(spark):
    df = corpus(spark)
    models = fit_topics(df, "tokens", "id", KEYS, ks=[2], passes=10)
    top = models.top_words(4).collect()
    for app in "AB":
        sets = [{r["word"] for r in top if r["app"] == app and r["topic"] == t} - {f"only{app}"} for t in (0, 1)]
        assert sets[0] <= {"sun", "sea", "sand", "beach"} or sets[0] <= {"code", "bug", "test", "crash"}
        assert not sets[0] & sets[1]
    empty = spark.createDataFrame([(999, "A", "s", "x", "", [])], df.schema)
    rows = topics.with_topic_probabilities(df.unionByName(empty), models, 2).collect()
    assert len(rows) == 121 and all(sum(r["lda_probs"]) == pytest.approx(1) for r in rows)
    assert next(r for r in rows if r["id"] == 999)["lda_probs"] == [0.5, 0.5]


def test_lda_of_nothing(spark):
    none = corpus(spark, 2).where("id < 0")
    models = fit_topics(none, "tokens", "id", KEYS, ks=[2], passes=2)
    assert models.words.count() == 0 and models.top_words(5).count() == 0 and models.probabilities(2).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, []), (3, [None, "a"])], "id int, tokens array<string>")
    models = fit_topics(nulls, "tokens", "id", ks=[2], passes=2)
    assert [r["word"] for r in models.words.collect()] == ["a"] and models.probabilities(2).count() == 1


def plain_cv(docs, topic_lists, window):
    words = {w for t in topic_lists for w in t}
    windows = [set(d[s : s + window]) for d in docs if words & set(d) for s in range(max(1, len(d) - window + 1))]
    out = []
    for ws in topic_lists:
        def p(*x):
            return sum(all(w in held for w in x) for held in windows) / len(windows)

        v = [[math.log((p(a, b) + 1e-12) / (p(a) * p(b))) / -math.log(p(a, b) + 1e-12) if p(a) and p(b) else 0.0 for b in ws] for a in ws]
        s = [sum(col) for col in zip(*v, strict=True)]
        cos = [sum(a * b for a, b in zip(row, s, strict=True)) / math.sqrt(sum(a * a for a in row) * sum(b * b for b in s)) for row in v]
        out.append(sum(cos) / len(cos))
    return out


@pytest.mark.parametrize("chunk", [3, 4096])
def test_sweep_as_one_model_at_a_time(spark, chunk, monkeypatch):
    monkeypatch.setattr(coherence, "_WINDOWS", chunk)
    rng = random.Random(5)
    docs = [("AB"[i % 2], [rng.choice("abcdefghij") for _ in range(rng.choice([0, 1, 8, 9, 30]))]) for i in range(60)]
    df = spark.createDataFrame([(a, "s", d) for a, d in docs] + [("C", "s", ["a"]), ("A", "s", None)], "app string, sentiment string, tokens array<string>")
    models = {("A", 2): [["a", "b", "c"], ["c", "d", "e"]], ("A", 1): [["f", "a", "b"]], ("B", 2): [["a", "j", "i"], ["b", "zz", "c"]]}
    rows = [(a, "s", k, t, i, w) for (a, k), ts in models.items() for t, ws in enumerate(ts) for i, w in enumerate(ws)]
    listed = spark.createDataFrame(rows, "app string, sentiment string, k int, topic int, i int, w string")
    got = {(r["app"], r["k"], r["topic"]): r["coherence"] for r in coherence.coherence_sweep(df, listed, KEYS, ["k"], window=9).collect()}
    for (a, k), ts in models.items():
        if ("B", 2) == (a, k):
            ts = ts[:1]
            mine = [d for x, d in docs if x == a]
            assert got[a, k, 0] == pytest.approx(plain_cv([d for d in mine], [["a", "j", "i"], ["b", "c"]], 9)[0])
            continue
        want = plain_cv([d for x, d in docs if x == a], ts, 9)
        assert [got[a, k, t] for t in range(len(ts))] == pytest.approx(want)
    assert coherence.coherence_sweep(df, listed.where("k > 5"), KEYS, ["k"]).count() == 0


def test_lda_numbers_its_words_once(spark):
    """Passes move numbers instead of words, blocks are filled segment by segment, and a segment may lack a name."""
    df = corpus(spark, 60)
    models = fit_topics(df.withColumn("app", F.when(F.col("app") == "A", "A")), "tokens", "id", KEYS, ks=[2], passes=2, block_rows=10)
    named = fit_topics(df, "tokens", "id", KEYS, ks=[2], passes=0)
    assert "words" not in models.bags.columns and models.needed.columns == ["_block", "_id"]
    sizes = [r["n"] for r in df.groupBy(*KEYS).agg(F.count("*").alias("n")).collect()]
    assert models.bags.select("_block").distinct().count() <= sum(-(-n // 10) for n in sizes)
    assert models.words.count() == named.words.count() and models.probabilities(2).count() == 60


def test_coherence_counts_in_pieces(spark, monkeypatch):
    """Counts do not depend on how many rows are counted at once."""
    from opinara.operators import coherence

    df = spark.createDataFrame([(["a", "b", "c"][: k % 4] + ["x"] * (k % 9),) for k in range(50)], "tokens array<string>").coalesce(1)
    whole = [sorted(part.collect()) for part in coherence.window_counts(df, [["a", "b", "x"]], window=4)]
    monkeypatch.setattr(coherence, "_ROWS", 7)
    assert [sorted(part.collect()) for part in coherence.window_counts(df, [["a", "b", "x"]], window=4)] == whole


def test_cluster_passes_send_sums_once_a_core(spark):
    """The sums of a pass are as large as the models, so that they must not be sent once for each piece of input."""
    cores = spark.sparkContext.defaultParallelism
    for parts in (2, 100):
        df = spark.range(0, 1000, numPartitions=parts)
        assert centroids._per_core(df).rdd.getNumPartitions() == min(parts, cores)


def test_lloyd_reads_only_segments_that_move(spark):
    """Two of three segments, two models of different size: new centroids are means of the nearest rows."""
    rng = np.random.default_rng(5)
    x, seg = rng.random((90, 4)), np.arange(90) % 3
    rows = spark.createDataFrame(
        [(int(s), i, (list(range(4)), v.tolist())) for i, (s, v) in enumerate(zip(seg, x))],
        "seg int, hash bigint, vector struct<indices: array<int>, values: array<double>>",
    )
    models = {(s, k, start): rng.random((k, 4)) for s in (0, 2) for k in (2, 3) for start in range(2)}
    models[0, 3, 1][2] = 50.0
    fresh, _ = centroids._lloyd(rows, models, 4, move=True)
    _, cost = centroids._lloyd(rows, models, 4, move=False)
    for key, c in models.items():
        mine = x[seg == key[0]]
        d = ((mine[:, None] - c[None]) ** 2).sum(axis=2)
        near = d.argmin(axis=1)
        want = [mine[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))]
        assert fresh[key] == pytest.approx(np.array(want))
        assert cost[key] == pytest.approx(d.min(axis=1).sum())


def test_topic_blocks_grow_with_the_input(spark):
    """Blocks that stay at 1,024 rows repeat the vocabulary of a large input once for each of them."""
    assert [lda._block_rows(n) for n in (0, 5_000, 320_000, 10_000_000)] == [1024, 1024, 10_000, 16_384]


def test_topic_blocks_of_any_size_agree(spark, monkeypatch):
    df = corpus(spark)
    monkeypatch.setattr(lda, "_LEAST_ROWS", 7)
    models = [fit_topics(df, "tokens", "id", KEYS, [2, 3], passes=3, block_rows=n) for n in (8, 1000)]
    tops = [{(r["app"], r["k"], r["topic"], r["word"]): r["weight"] for r in m.top_words(99).collect()} for m in models]
    assert tops[0] == pytest.approx(tops[1])
    probs = [{r["id"]: list(r["probs"]) for r in m.probabilities(3).collect()} for m in models]
    assert probs[0].keys() == probs[1].keys()
    assert all(probs[0][i] == pytest.approx(probs[1][i]) for i in probs[0])
