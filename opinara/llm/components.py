"""Connected components of a distributed edge list."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.session import saved

PART_EDGES = 200_000

def _forest(edges: DataFrame) -> DataFrame:
    """Each partition's edges replaced by a star for each of its own components."""

    def run(batches):
        parent: dict = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def stars():
            found = [(x, root(x)) for x in parent]
            rows = [(x, r) for x, r in found if x != r]
            parent.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], types[k]) for k in (0, 1)], ["a", "b"]
            )

        types = None
        for batch in batches:
            types = [batch.schema.field(k).type for k in (0, 1)]
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > 500_000:
                yield stars()
        if parent:
            yield stars()

    return edges.mapInArrow(run, edges.schema)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to their smallest one: those above a node, or the node and those below it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = saved(near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    if large:
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _settled(stars: DataFrame) -> bool:
    """Whether every node has one leader and no leader has one."""
    state = stars.agg(F.count("*"), F.count_distinct("a")).first()
    return state[0] == state[1] and stars.join(stars.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of edges (a, b); component is the smallest id reachable.

    Partitions first contract their own edges, then parts of PART_EDGES of what is
    left; alternating large and small stars, each round written to the work folder, do
    the rest. Nodes may have any ordered type; loops, repeated edges, and edges with a
    null end are harmless. An empty edge list has no nodes.
    """
    pairs = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    now = saved(_forest(pairs), "edges")
    now = saved(_forest(now.repartition(max(1, -(-now.count() // PART_EDGES)))), "edges")
    while not _settled(now):
        now = saved(_star(saved(_star(now, large=True), "large-star"), large=False), "small-star")
    leaders = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return saved(now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(leaders), "components")
