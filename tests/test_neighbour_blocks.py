"""Blocks of a neighbour search grow with the number of their pairs; the result stays exact."""

from __future__ import annotations

import numpy as np
import pytest

from opinara.operators import neighbours


def test_bins_hold_cells_of_one_group():
    pivots = np.array([[0.0], [9.0], [1.0], [5.0], [0.5]])
    bins = neighbours._bins([10, 10, 10, 50, 10, 7], np.array([0, 0, 0, 0, 1]), pivots, 25)
    assert bins.tolist() == [0, 2, 0, 1, 3, 4]


@pytest.mark.parametrize("group", [None, "g"])
def test_many_small_blocks_become_fewer(spark, monkeypatch, group):
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 3 == 0) if i % 50 else 2, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, g int, v array<double>").repartition(3)
    pairs = []
    split = neighbours._split_pairs

    def counted(queries, base, blocks, queries_per_cell, query_rows):
        pairs.append(neighbours._pairs(blocks, queries_per_cell, query_rows))
        return split(queries, base, blocks, queries_per_cell, query_rows)

    monkeypatch.setattr(neighbours, "_split_pairs", counted)

    def found(most):
        monkeypatch.setattr(neighbours, "_PAIRS", most)
        asked, base = df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "b")
        got = neighbours.nearest(asked, base, 4, 8, "q", "b", "v", "euclidean", exclude_self=True, cell_rows=16, block_rows=5, query_rows=5, group=group)
        return sorted((r["q"], r["rank"], r["b"], r["dist_nano"]) for r in got.collect())

    assert found(10**9) == found(20)
    # The last search of each run; the one before it bounds the distances, one pair for each home block and no more.
    assert pairs[3] < pairs[1] / 8
    assert pairs[0] == pairs[2]
    near = {(q, r): b for q, r, b, _ in found(20)}
    for i, g, x in rows[::17]:
        far = sorted((np.floor(sum((s - t) ** 2 for s, t in zip(x, y)) * 1e9 + 0.5), b) for b, h, y in rows if b != i and (group is None or h == g))[:4]
        assert [near[i, n + 1] for n in range(len(far))] == [b for _, b in far]
