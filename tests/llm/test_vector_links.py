"""NN-descent links against all pairs of vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from brute import classes

from opinara.llm import vector_links as V
from opinara.llm.vector_links import vector_links
from opinara.session import saved


def expected(rows):
    ok = {k: np.array(e, np.float64) for k, (_, e) in enumerate(rows) if e and all(x is not None and math.isfinite(x) for x in e) and any(e)}
    links = [
        (a, b) for a in ok for b in ok
        if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= 0.95
    ]
    top = classes(range(len(rows)), links)
    degree = {k: 0 for k in range(len(rows))}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    least: dict = {}
    for k, (vec, _) in enumerate(rows):
        if vec is not None:
            least[top[k]] = min(least.get(top[k], vec), vec)
    return sorted([(v, degree[k], least.get(top[k]), least.get(top[k]) == v) for k, (v, _) in enumerate(rows)], key=str)


def found(df):
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_links(df).collect()], key=str)


def test_clusters_copies_and_bridges(spark):
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x)
    out = [rng.normal(size=32) for _ in range(500)]
    for _ in range(40):
        x = unit(rng.normal(size=32))
        out += [x, x + rng.normal(size=32) * 0.03]
    centre, other = unit(rng.normal(size=32)), unit(rng.normal(size=32))
    out += [centre + rng.normal(size=32) * 0.02 for _ in range(120)]
    side = unit(other - (other @ centre) * centre)
    far = unit(centre * math.cos(0.45) + side * math.sin(0.45))
    out += [far + rng.normal(size=32) * 0.02 for _ in range(60)]
    out.append(unit(centre + far))  # joins two saturated clusters
    out += [out[3]] * 30
    rows = [(k, [float(np.float32(v)) for v in x]) for k, x in enumerate(out)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert found(df) == expected(rows)


def test_links_between_saturated_groups(spark):
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x)
    out = [rng.normal(size=32) for _ in range(300)]
    for _ in range(3):
        centre = unit(rng.normal(size=32))
        for _ in range(20):  # each of 20, tight, and linked with all others of its centre
            sub = unit(centre + 0.14 * unit(rng.normal(size=32)))
            out += [sub + rng.normal(size=32) * 0.001 for _ in range(20)]
    rows = [(k, [float(np.float32(v)) for v in x]) for k, x in enumerate(out)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert found(df) == expected(rows)


def test_cuts_change_with_table_and_attempt(spark):
    ids = spark.range(200).selectExpr("cast(cast(id as string) as binary) as id", "4 as parts")
    cuts = ids.select(*[V._cut("id", V.F.lit(cell), V.F.lit(seed)).alias(f"c{cell}{seed}") for cell in range(2) for seed in range(2)]).collect()
    assert len({tuple(r[k] for r in cuts) for k in range(4)}) == 4 and {r[0] for r in cuts} == {0, 1, 2, 3}


def test_audit_counts_pairs_once_and_short_recall_is_an_error(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 16))
    out = [b + rng.normal(size=16) * 0.01 for b in base for _ in range(2)]
    rows = [(k, [float(np.float32(v)) for v in x]) for k, x in enumerate([*out, *[out[0], out[1]] * 500])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    raw, kind = V._items(df)
    items = saved(raw.groupBy("id").agg(V.F.any_value("vec").alias("vec"), V.F.count("*").alias("copies")).withColumn("comp", V.F.col("id")), "items")
    heavy = saved(items.orderBy(V.F.desc("copies")).limit(2).select("id", V.F.lit(501).alias("links"), V.F.lit(1).alias("pairs")), "heavy")
    assert V.audit(items, heavy, kind, 0.95, 200) == (2, 60)
    assert V.audited(10**6) > V.audited(10**4) > V.audited(100) == 100
    monkeypatch.setattr(V, "audit", lambda *a: (9, 10))
    with pytest.raises(RuntimeError, match="9 of 10"):
        vector_links(df, attempts=1)


def test_edge_cases(spark):
    nan = float("nan")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.1]), (2, [2.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [1.0, 0.0, 0.0]),
        (9, [-1.0, 0.0]), (None, [1.0, 0.01]), (None, [0.0, 3.0]), (10, [float("inf"), 1.0]), (11, [-0.0, 3.0]),
    ]
    for kind in ("float", "double"):
        df = spark.createDataFrame([(*r, 7, "x") for r in rows], f"vec_id long, embedding array<{kind}>, comp int, near string")
        assert found(df) == expected(rows)
    assert vector_links(df.limit(0)).count() == 0
