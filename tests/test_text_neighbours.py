"""The inverted-index search and the level-wise n-gram counts against plain versions."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import features, text_neighbours
from opinara.operators.text_neighbours import nearest_texts, visits
from opinara.session import saved

DIM = 60
SCHEMA = "id string, v struct<indices: array<int>, values: array<double>>, label int"


def sparse(rng, n, name, themes=6):
    rows = []
    for i in range(n):
        theme = i % themes
        own = [theme * 8 + rng.randrange(8) for _ in range(rng.randint(0, 6))]
        common = [48 + rng.randrange(12) for _ in range(rng.randint(0, 3))]
        terms = sorted(set(own + common))
        weight = [rng.choice([1.0, 2.0, 0.5]) * (0.2 if t >= 48 else 1.0) for t in terms]
        rows.append((f"{name}{i}", (terms, weight), theme))
    return rows


def plain(queries, base, k, exclude_self=False):
    def dense(v):
        x = np.zeros(DIM)
        x[v[0]] = v[1]
        n = np.linalg.norm(x)
        return x / n if n else x

    out = {}
    for q, v, _ in queries:
        x = dense(v)
        found = [(int(np.floor((1 - x @ dense(w)) * 1e9 + 0.5)), b) for b, w, _ in base if not (exclude_self and b == q)]
        out[q] = sorted(found)[:k]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["q"], []).append((r["dist_nano"], r["b"]))
    return out


def near(a, b):
    """Equal ids, and distances equal up to a rounding of the last unit."""
    assert set(a) == set(b)
    for q in a:
        assert [d for d, _ in a[q]] == pytest.approx([d for d, _ in b[q]], abs=1)
        if len({d for d, _ in b[q]}) == len(b[q]):
            assert [i for _, i in a[q]] == [i for _, i in b[q]]


@pytest.mark.parametrize("block_rows,query_rows,together", [(1000, 1000, 100), (9, 5, 3)])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_exact(spark, block_rows, query_rows, together, exclude_self):
    rng = random.Random(4)
    base = sparse(rng, 90, "b") + [("zero", ([], []), 0), ("nil", ([3], [0.0]), 0)]
    base += [(f"copy{i}", base[7][1], 1) for i in range(12)]
    queries = sparse(rng, 40, "b") + [("zero", ([], []), 0), ("odd", ([59], [2.0]), 0)]
    found = nearest_texts(
        spark.createDataFrame(queries, SCHEMA).withColumnRenamed("id", "q"), spark.createDataFrame(base, SCHEMA).withColumnRenamed("id", "b"),
        5, DIM, "q", "b", "v", ["label"], exclude_self, block_rows, query_rows, together,
    )
    near(got(found), plain(queries, base, 5, exclude_self))


def test_ties_go_by_id(spark):
    base = [(f"b{i:02d}", ([0, 1], [1.0, 1.0]), 0) for i in range(30)]
    queries = [("q", ([0], [1.0]), 0), ("none", ([5], [1.0]), 0)]
    found = nearest_texts(
        spark.createDataFrame(queries, SCHEMA).withColumnRenamed("id", "q"), spark.createDataFrame(base, SCHEMA).withColumnRenamed("id", "b"),
        4, DIM, "q", "b", "v", block_rows=7,
    )
    assert {q: [b for _, b in rows] for q, rows in got(found).items()} == {x: ["b00", "b01", "b02", "b03"] for x in ("q", "none")}


def test_most_blocks_are_not_visited(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1200):
        theme = i % 40
        terms = sorted({theme * 20 + rng.randrange(20) for _ in range(8)})
        rows.append((f"r{i:04d}", (terms, [1.0] * len(terms)), theme))
    df = spark.createDataFrame(rows, SCHEMA)
    side = df.select(F.col("id").alias("_b"), F.col("v").alias("_v"))
    base = saved(side.withColumn("_cell", text_neighbours._cell(F.col("_v"))), "b")
    q = saved(side.withColumnRenamed("_b", "_q").withColumn("_cell", text_neighbours._cell(F.col("_v"))), "q")
    chosen, placed = visits(q, base, 3, 800, True, 16, 256, 8)
    blocks = placed.select("_block").distinct().count()
    pairs = chosen.select(F.sum(F.size("_blocks"))).first()[0]
    assert blocks > 60 and pairs < 0.2 * blocks * len(rows)


def plain_ngrams(docs, low, high, limit, min_df):
    ctf, df = Counter(), Counter()
    for d in docs:
        grams = [" ".join(d[i : i + n]) for n in range(low, high + 1) for i in range(len(d) - n + 1)]
        ctf.update(grams)
        df.update(set(grams))
    kept = sorted((t for t in ctf if df[t] >= min_df), key=lambda t: (-ctf[t], t))[:limit]
    return {t: (ctf[t], df[t]) for t in kept}


@pytest.mark.parametrize("low,high,limit,min_df", [(1, 3, 25, 1), (1, 3, 2000, 1), (1, 2, 12, 3), (1, 1, 5, 1), (2, 3, 20, 2), (1, 3, 40, 2)])
def test_levels_find_the_same_terms(spark, low, high, limit, min_df):
    rng = random.Random(limit)
    words = [f"w{i}" for i in range(40)]
    docs = [[words[min(39, int(rng.expovariate(0.15)))] for _ in range(rng.randint(0, 40))] for _ in range(80)] + [["w1", "w2", "w3"] * 30, []]
    df = spark.createDataFrame([(d,) for d in docs] + [(None,)], "tokens array<string>").repartition(6)
    model = features.fit_ngrams(df, F.col("tokens"), (low, high), limit, min_df)
    assert dict(zip(model.terms, zip(model.ctf, model.df, strict=True), strict=True)) == plain_ngrams(docs, low, high, limit, min_df)
    assert model.terms == sorted(model.terms) and model.n_docs == 83
    rows = df.withColumn("id", F.monotonically_increasing_id()).select("id", "tokens", features.ngram_weights(F.col("tokens"), model.terms, model.idf).alias("w"))
    for r in rows.collect():
        tokens = r["tokens"] or []
        tf = Counter(" ".join(tokens[i : i + n]) for n in range(low, high + 1) for i in range(len(tokens) - n + 1))
        raw = {t: (1 + math.log(tf[t])) * model.idf[i] for i, t in enumerate(model.terms) if tf[t]}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        assert dict(zip([model.terms[i] for i in r["w"]["indices"]], r["w"]["values"], strict=True)) == pytest.approx({t: x / norm for t, x in raw.items()})
