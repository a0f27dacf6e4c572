"""Exact k nearest neighbours as a block join, and what is built on it.

Base vectors are assigned to the nearest of a bounded set of pivots; each cell
is cut into blocks of bounded size. A query first looks at one block of its own
cell, which bounds the distance of its k-th neighbour from above. It then visits
only the cells that the triangle inequality cannot rule out. A task holds one
block of queries and one block of base vectors and emits at most k rows per
query, never the pairs. No candidate is dropped: the result is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.hash_order import cut_by_hash, group_sizes, numbered
from opinara.session import saved

_NANO = 1e9
_SLACK = 1e-6
_PIVOT_CELLS = 4_000_000
_PIECE_ROWS = 512
# Pairs of a block of base rows and a block of queries, beyond which blocks grow up to so many rows.
_PAIRS = 1024
_BLOCK_ROWS = 4096


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _in_pieces(of: Callable[..., pa.Array], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """What `of` gives for the columns, taken some rows at a time: it holds a number for each row and pivot."""
    at = range(0, len(columns[0]), _PIECE_ROWS)
    return pa.concat_arrays([pa.array([], kind), *[of(*[c.slice(i, _PIECE_ROWS) for c in columns]).cast(kind) for i in at]])


def _matrix(column, dim: int, metric: str, side: int) -> np.ndarray:
    """Rows as float64. For 'cosine' on the unit sphere, with two spare axes.

    A zero vector has cosine distance 1 to everything; it is put on a spare axis
    (one for queries, one for base rows), which gives just that.
    """
    col = _one(column)
    n = len(col)
    width = dim + 2 if metric == "cosine" else dim
    out = np.zeros((n, width))
    if pa.types.is_struct(col.type):
        idx, val = _one(col.field("indices")), _one(col.field("values"))
        rows = np.repeat(np.arange(n), np.diff(idx.offsets.to_numpy()))
        out[rows, idx.flatten().to_numpy()] = val.flatten().to_numpy()
    elif n:
        out[:, :dim] = col.flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
    if metric == "cosine":
        norm = np.sqrt(np.einsum("ij,ij->i", out, out))
        empty = norm == 0
        out[~empty] /= norm[~empty, None]
        out[empty, dim + side] = 1.0
    return out


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def _ranked(squared: np.ndarray, metric: str) -> np.ndarray:
    """Order key: cosine distance (half the squared chord) or squared distance, in nano units."""
    return np.floor((squared / 2 if metric == "cosine" else squared) * _NANO + 0.5).astype("int64")


def _radius(nano: np.ndarray, metric: str) -> np.ndarray:
    """Straight-line distance for an order key."""
    return np.sqrt(nano / _NANO * (2 if metric == "cosine" else 1))


def _top_block(left: pa.Table, right: pa.Table, k: int, dim: int, metric: str, exclude_self: bool, step: int = 512):
    """(query row, base row, key) of the k smallest keys per query, ties by base id."""
    right = right.take(pc.sort_indices(right["_b"]))
    base = _matrix(right["_v"], dim, metric, 0)
    limit = left["_ub"].to_numpy()
    both = pa.concat_arrays([_one(left["_q"]).cast(right["_b"].type), _one(right["_b"])]).dictionary_encode() if exclude_self else None
    codes = both.indices.to_numpy() if exclude_self else None
    rows, cols, keys = [], [], []
    for at in range(0, left.num_rows, step):
        part = left.slice(at, step)
        d = _ranked(_squared(_matrix(part["_v"], dim, metric, 1), base), metric)
        m = d.shape[1]
        ok = d <= limit[at : at + step, None]
        if exclude_self:
            ok &= codes[at : at + part.num_rows, None] != codes[left.num_rows :][None, :]
        # Key and position in one number keep ties in id order.
        if d.max(initial=0) > np.iinfo("int64").max // (m + 1) - 1:
            levels, place = np.unique(d, return_inverse=True)
            d = place.reshape(d.shape)
        else:
            levels = None
        order = np.where(ok, d * m + np.arange(m), np.iinfo("int64").max)
        if m > k:
            order = np.partition(order, k - 1, axis=1)[:, :k]
        r, c = np.nonzero(order != np.iinfo("int64").max)
        found = order[r, c]
        rows.append(r + at)
        cols.append(found % m)
        keys.append(found // m if levels is None else levels[found // m])
    return right, np.concatenate(rows), np.concatenate(cols), np.concatenate(keys)


def _blocks_of(cells: Sequence[int], block_rows: int) -> list[int]:
    return [max(1, -(-n // block_rows)) for n in cells] or [1]


def _pairs(blocks: list[int], queries_per_cell: dict[int, int], query_rows: int) -> int:
    return sum(n * -(-queries_per_cell.get(c, 0) // query_rows) for c, n in enumerate(blocks))


def _bins(cells: Sequence[int], owner: np.ndarray, pivots: np.ndarray, rows: int) -> np.ndarray:
    """The bin of each cell: cells of a group, in order of distance from its first pivot, fill bins of up to `rows` base rows."""
    bins = np.zeros(len(cells), "int32")
    last = -1
    for group in np.unique(owner):
        mine = np.flatnonzero(owner == group)
        held = rows
        for c in mine[np.argsort(_squared(pivots[mine[:1]], pivots[mine])[0], kind="stable")]:
            if held + cells[c] > rows:
                last, held = last + 1, 0
            bins[c] = last
            held += cells[c]
    lone = np.arange(len(owner), len(cells))
    bins[lone] = last + 1 + np.arange(len(lone))
    return bins


def _visitors(wide: DataFrame) -> dict[int, int]:
    """Number of queries that visit each cell."""
    seen = wide.select(F.explode("_cells").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return {r["c"]: r["n"] for r in seen.collect()}


def _split_pairs(queries: DataFrame, base: DataFrame, blocks: list[int], queries_per_cell: dict[int, int], query_rows: int):
    """Give queries and base the same (cell, block, part) keys; parts bound the query side."""
    parts = [max(1, -(-queries_per_cell.get(c, 0) // query_rows)) for c in range(len(blocks))]
    parts_of = F.lit(np.array(parts, dtype="int32"))
    part = F.pmod(F.xxhash64("_q", F.lit(7)), F.get(parts_of, F.col("_cell"))).cast("int")
    q = queries.withColumn("_part", part)
    b = base.withColumn("_part", F.explode(F.sequence(F.lit(0), F.get(parts_of, F.col("_cell")) - 1)))
    keys = ["_cell", "_block", "_part"]
    return q.groupBy(*keys).cogroup(b.groupBy(*keys))


def _pivots(base: DataFrame, cells: dict[int, int]) -> pa.Table:
    """(_g, _v) of as many base rows of each group as it is to have cells, first in hash order.

    A share of the hash range a few times as wide as needed is ranked, not the whole group.
    """
    if len(cells) == 1:
        return base.orderBy(F.xxhash64("_b"), "_b").limit(sum(cells.values())).select("_g", "_v").toArrow()
    wanted = base.sparkSession.createDataFrame(list(cells.items()), "_g int, _c int")
    sizes = base.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).join(wanted, "_g")
    place = (F.xxhash64("_b") / 2.0**64) + 0.5
    some = base.join(sizes, "_g").where(place * F.col("_n") <= 4 * F.col("_c") + 40)
    w = Window.partitionBy("_g").orderBy(F.xxhash64("_b"), "_b")
    picks = some.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.col("_c"))
    return picks.orderBy("_g", "_r").select("_g", "_v").toArrow()


def _cells_of(sizes: dict[int, int], cell_rows: int, most: int) -> dict[int, int]:
    """Cells of each group that is to have more than one; `most` in all, shared out by size."""
    wanted = {g: -(-n // cell_rows) for g, n in sizes.items()}
    scale = min(1.0, most / max(1, sum(wanted.values())))
    return {g: int(n * scale) for g, n in wanted.items() if int(n * scale) > 1}


def nearest(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    dim: int,
    query_id: str = "query_id",
    base_id: str = "base_id",
    vector: str = "vector",
    metric: str = "cosine",
    carry: Sequence[str] = (),
    exclude_self: bool = False,
    cell_rows: int = 4096,
    block_rows: int = 4096,
    query_rows: int = 4096,
    max_cells: int = 1024,
    n_base: int | None = None,
    n_queries: int | None = None,
    group: str | None = None,
) -> DataFrame:
    """The k nearest base rows of every query: query_id, base_id, carry..., dist_nano, rank.

    `vector` is an array of `dim` numbers or a struct (indices, values) below
    `dim`. dist_nano is the cosine distance or the squared Euclidean distance in
    units of 1e-9; equal distances rank by base id. Row counts that are already
    known may be passed in. `block_rows` and `query_rows` hold as long as a thousand pairs of
    blocks do: since their number grows with both inputs, cells are then merged and blocks grow,
    up to 4,096 rows. With `group`, an int column of both sides numbered from 0,
    neighbours are base rows of the query's group; all groups are searched in one job.
    """
    g = F.lit(0) if group is None else F.col(group)
    b = base.select(F.col(base_id).alias("_b"), *carry, F.col(vector).alias("_v"), g.cast("int").alias("_g"))
    q = queries.select(F.col(query_id).alias("_q"), F.col(vector).alias("_v"), g.cast("int").alias("_g"))
    if group is None:
        sizes = {0: base.count() if n_base is None else n_base}
    else:
        b, q = saved(b, "base-vectors"), saved(q, "query-vectors")
        sizes = {r["_g"]: r["n"] for r in b.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).collect()}
        q = q.where(F.col("_g").isin(*sizes))
    split = _cells_of(sizes, cell_rows, int(min(max_cells, max(1, _PIVOT_CELLS // dim))))
    if split and group is None:
        # Both sides are read several times; compute the vectors once.
        b, q = saved(b, "base-vectors"), saved(q, "query-vectors")

    # Cells with pivots come first, then one cell for each group without pivots.
    owner, pivots = np.zeros(0, "int64"), np.zeros((0, dim))
    if split:
        picks = _pivots(b.where(F.col("_g").isin(*split)), split)
        owner, pivots = picks["_g"].to_numpy(), _matrix(picks["_v"], dim, metric, 0)
    single = sorted(set(sizes) - set(owner.tolist()))
    lone = np.full(max(sizes, default=0) + 1, -1, "int32")
    lone[single] = len(owner) + np.arange(len(single))
    lone_of = F.get(F.lit(lone), F.col("_g"))
    n_cells = len(owner) + len(single)
    cells, radius = [0] * len(owner) + [sizes[x] for x in single], np.full(len(owner), -np.inf)

    if not split:
        placed = b.withColumn("_cell", lone_of)
    else:

        def placing(v: pa.Array, groups: pa.Array) -> pa.Array:
            of = groups.to_numpy()
            d = np.where(owner[None, :] == of[:, None], _squared(_matrix(v, dim, metric, 0), pivots), np.inf)
            cell = d.argmin(axis=1)
            apart = np.where(lone[of] < 0, np.sqrt(d[np.arange(len(cell)), cell]), 0.0)
            return pa.StructArray.from_arrays(
                [pa.array(np.where(lone[of] < 0, cell, lone[of]).astype("int32")), pa.array(apart)], names=["cell", "d"]
            )

        @F.arrow_udf("cell int, d double")
        def place(v: pa.Array, groups: pa.Array) -> pa.Array:
            return _in_pieces(placing, pa.struct([("cell", pa.int32()), ("d", pa.float64())]), v, groups)

        placed = saved(b.withColumn("_p", place("_v", "_g")).select("*", "_p.cell", "_p.d").drop("_p"), "cells")
        summary = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r")).collect()
        for row in summary:
            if row["cell"] < len(owner):
                cells[row["cell"]], radius[row["cell"]] = row["n"], row["r"]
        placed = placed.withColumnRenamed("cell", "_cell").drop("d")

    def blocked(rows: DataFrame) -> DataFrame:
        of = F.get(F.lit(np.array(blocks, dtype="int32")), F.col("_cell"))
        return rows.withColumn("_block", F.pmod(F.xxhash64("_b"), of).cast("int"))

    blocks = _blocks_of(cells, block_rows)
    placed = blocked(placed)
    far = np.iinfo("int64").max

    if not split:
        wide = q.withColumns({"_ub": F.lit(int(far)), "_cells": F.array(lone_of)})
    else:
        wide = _bounded(q, placed, pivots, owner, lone, cells, radius, blocks, k, dim, metric, exclude_self, query_rows)
        wide = saved(wide, "bounded-queries")
    if n_cells == 1 and n_queries is not None:
        per_cell = {0: n_queries}
    else:
        per_cell = _visitors(wide)
    pairs = _pairs(blocks, per_cell, query_rows)
    if pairs > _PAIRS:
        most = max(1, min(_BLOCK_ROWS, _PIVOT_CELLS // dim))
        block_rows, query_rows = (max(n, min(int(n * (pairs / _PAIRS) ** 0.5), most)) for n in (block_rows, query_rows))
        bins = _bins(cells, owner, pivots, block_rows)
        bin_of = F.lit(bins)
        blocks = _blocks_of(np.bincount(bins, weights=cells).astype(int).tolist(), block_rows)
        placed = blocked(placed.withColumn("_cell", F.get(bin_of, F.col("_cell"))))
        wide = wide.withColumn("_cells", F.array_distinct(F.transform("_cells", lambda c: F.get(bin_of, c))))
        per_cell = _visitors(wide)
    blocks_of = F.lit(np.array(blocks, dtype="int32"))

    visits = wide.select("_q", "_v", "_ub", F.explode("_cells").alias("_cell")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.get(blocks_of, F.col("_cell")) - 1))
    )
    placed = placed.drop("_g")
    fields = [T.StructField("_q", q.schema["_q"].dataType), T.StructField("_b", b.schema["_b"].dataType)]
    fields += [b.schema[c] for c in carry] + [T.StructField("dist_nano", T.LongType())]
    schema = T.StructType(fields)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            left, right = left.slice(0, 0), right.slice(0, 0)
            rows = cols = keys = np.array([], dtype="int64")
        else:
            right, rows, cols, keys = _top_block(left, right, k, dim, metric, exclude_self)
        found = right.take(pa.array(cols, pa.int64()))
        return pa.table(
            [left["_q"].take(pa.array(rows, pa.int64())), *[found[c] for c in ("_b", *carry)], pa.array(keys, pa.int64())],
            names=["_q", "_b", *carry, "dist_nano"],
        )

    found = _split_pairs(visits, placed, blocks, per_cell, query_rows).applyInArrow(search, schema)
    w = Window.partitionBy("_q").orderBy("dist_nano", "_b")
    top = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(F.col("_q").alias(query_id), F.col("_b").alias(base_id), *carry, "dist_nano", "rank")


def _bounded(
    q: DataFrame, placed: DataFrame, pivots: np.ndarray, owner: np.ndarray, lone: np.ndarray, cells: list[int],
    radius: np.ndarray, blocks: list[int], k: int, dim: int, metric: str, exclude_self: bool, query_rows: int,
) -> DataFrame:
    """Add to each query its bound `_ub` and the cells `_cells` it has to visit.

    `owner` is the group of each pivot, `lone` the only cell of a group without pivots, else -1.
    """
    filled = np.array(cells[: len(owner)]) > 0
    between = np.sqrt(_squared(pivots, pivots))
    far = np.iinfo("int64").max

    def homing(v: pa.Array, groups: pa.Array) -> pa.Array:
        of = groups.to_numpy()
        mine = filled[None, :] & (owner[None, :] == of[:, None])
        d = np.where(mine, _squared(_matrix(v, dim, metric, 1), pivots), np.inf)
        return pa.array(np.where(lone[of] < 0, d.argmin(axis=1), lone[of]).astype("int32"))

    @F.arrow_udf("int")
    def home_cell(v: pa.Array, groups: pa.Array) -> pa.Array:
        return _in_pieces(homing, pa.int32(), v, groups)

    blocks_of = F.lit(np.array(blocks, dtype="int32"))
    homed = q.withColumn("_cell", home_cell("_v", "_g"))
    homed = homed.withColumn("_block", F.pmod(F.xxhash64("_q"), F.get(blocks_of, F.col("_cell"))).cast("int"))
    homed = homed.withColumn("_ub", F.lit(int(far)))
    # The queries of a cell are dealt to its blocks.
    counts = homed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()
    per_cell = {r["_cell"]: -(-r["n"] // blocks[r["_cell"]]) for r in counts}
    schema = T.StructType([q.schema["_q"], q.schema["_v"], q.schema["_g"], T.StructField("_ub", T.LongType())])

    def bound(left: pa.Table, right: pa.Table) -> pa.Table:
        ub = np.full(left.num_rows, far)
        if left.num_rows and right.num_rows:
            _, rows, _, keys = _top_block(left, right, k, dim, metric, exclude_self)
            seen = np.bincount(rows, minlength=left.num_rows)
            worst = np.zeros(left.num_rows, dtype="int64")
            np.maximum.at(worst, rows, keys)
            ub = np.where(seen >= k, worst, far)
        return pa.table([left["_q"], left["_v"], left["_g"], pa.array(ub, pa.int64())], names=["_q", "_v", "_g", "_ub"])

    narrow = placed.select("_b", "_v", "_cell", "_block")
    looked = _split_pairs(homed, narrow, blocks, per_cell, query_rows).applyInArrow(bound, schema)

    def reached(v: pa.Array, ub: pa.Array, groups: pa.Array) -> pa.Array:
        of = groups.to_numpy()
        d = np.sqrt(_squared(_matrix(v, dim, metric, 1), pivots))
        limit = ub.to_numpy()
        reach = np.where(limit == far, np.inf, _radius(limit + 1.0, metric)) + _SLACK
        out = []
        for row, r, group in zip(d, reach, of):
            if lone[group] >= 0:
                out.append(lone[group : group + 1])
                continue
            mine = filled & (owner == group)
            near = np.where(mine, row, np.inf).argmin()
            # A base row lies no farther from its pivot than the cell radius, and
            # on its pivot's side of the plane halfway to any other pivot.
            low = row - radius
            gap = between[near]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(gap > 0, (row**2 - row[near] ** 2) / (2 * gap), -np.inf)
            out.append(np.nonzero(mine & (np.maximum(low, plane) <= r))[0].astype("int32"))
        return pa.array(out, pa.list_(pa.int32()))

    @F.arrow_udf("array<int>")
    def cells_to_visit(v: pa.Array, ub: pa.Array, groups: pa.Array) -> pa.Array:
        return _in_pieces(reached, pa.list_(pa.int32()), v, ub, groups)

    return looked.withColumn("_cells", cells_to_visit("_v", "_ub", "_g"))


def vote(
    neighbours: DataFrame, query_id: str, label: str, name: str = "prediction", weights: str = "distance", metric: str = "cosine"
) -> DataFrame:
    """Label with the largest sum of weights: 1 / distance, or 1 each for 'uniform'.

    With distances, a zero distance takes all weight. Equal sums go to the smaller label.
    Sums are compared in thousandths.
    """
    d = F.col("dist_nano")
    if weights == "uniform":
        weight = F.lit(1.0)
    else:
        exact = F.min(d).over(Window.partitionBy(query_id)) == 0
        apart = 1e9 / d if metric == "cosine" else F.sqrt(1e9 / d)
        weight = F.when(exact, (d == 0).cast("double")).otherwise(apart)
    per = neighbours.withColumn("_w", weight).groupBy(query_id, label).agg(F.floor(F.sum("_w") * 1000 + 0.5).alias("_s"))
    best = F.max_by(label, F.struct("_s", (-F.col(label)).alias("l")))
    return per.groupBy(query_id).agg(best.alias(name))


def knn_neighbours(
    test: DataFrame, train: DataFrame, dim: int, id_col: str, label: str, vector: str = "vector", k: int = 5,
    search: Callable[..., DataFrame] = nearest, metric: str = "cosine", **options,
) -> DataFrame:
    """The k nearest training rows of each test row, with their labels, as `knn_classify` wants them."""
    return search(
        test.withColumnRenamed(id_col, "query_id"), train.withColumnRenamed(id_col, "base_id"), k, dim,
        vector=vector, carry=[label], metric=metric, **options,
    )


def knn_classify(
    test: DataFrame, train: DataFrame, dim: int, id_col: str, label: str, vector: str = "vector", k: int = 5,
    search: Callable[..., DataFrame] = nearest, metric: str = "cosine", weights: str = "distance",
    found: DataFrame | None = None, **options,
) -> DataFrame:
    """k-nearest-neighbour labels for the test rows.

    `search` is `nearest`, or `text_neighbours.nearest_texts` for sparse vectors of texts;
    `metric` is 'cosine' or 'euclidean', `weights` 'distance' or 'uniform'. `found` are the
    neighbours by the same metric if they are there already, k or more of each row.
    """
    if found is None:
        found = knn_neighbours(test, train, dim, id_col, label, vector, k, search, metric, **options)
    first = found.where(F.col("rank") <= k)
    return vote(first, "query_id", label, weights=weights, metric=metric).withColumnRenamed("query_id", id_col)


def _hash_int(text: Column, start: int) -> Column:
    """Eight hex digits of md5 as a number."""
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def interpolate(x: Column, y: Column, u: Column, sparse: bool) -> Column:
    """x + u * (y - x) for two vectors."""
    if not sparse:
        return F.zip_with(x, y, lambda a, b: a + u * (b - a))
    zero = F.lit(0.0)
    mixed = F.map_zip_with(
        F.map_from_arrays(x["indices"], x["values"]),
        F.map_from_arrays(y["indices"], y["values"]),
        lambda i, a, b: F.coalesce(a, zero) + u * (F.coalesce(b, zero) - F.coalesce(a, zero)),
    )
    entries = F.sort_array(F.map_entries(mixed))
    return F.struct(entries["key"].alias("indices"), entries["value"].alias("values"))


def smote(
    df: DataFrame, dim: int, id_col: str, label: str, vector: str = "vector", k: int = 5, metric: str = "euclidean", **options
) -> DataFrame:
    """Synthetic rows that bring every class to the size of the largest.

    A class that lacks rows spreads them evenly over its members in hash order.
    Each synthetic row lies between a member and one of its k nearest members of
    the class; neighbour and place are drawn from the hash of (id, copy).
    Columns: id, copy, neighbour id, u, label, vector. Ids that repeat are an error, since a
    row is found again by its id.
    """
    twice = df.where(F.col(label).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if twice:
        raise ValueError(f"ids of more than one row: {[r[id_col] for r in twice]}")
    sizes = group_sizes(df, label)
    target = max(sizes.values(), default=0)
    short = {c: n for c, n in sizes.items() if n < target}
    alone = [c for c, n in short.items() if n < 2]
    if alone:
        raise ValueError(f"classes with a single row cannot be interpolated: {alone}")
    rows = df.select(id_col, label, vector)
    if not short:
        none = rows.where(F.lit(False))
        return none.select(
            id_col, F.lit(0).cast("bigint").alias("copy"), F.col(id_col).alias("neighbour"), F.lit(0.0).alias("u"), label, vector
        )
    # One row for each short class: its number, how often each member is copied, how many neighbours it has.
    kind = df.schema[label].dataType.simpleString()
    classes = df.sparkSession.createDataFrame(
        [(c, i, (target - n) // n, min(k, n - 1)) for i, (c, n) in enumerate(short.items())],
        f"`{label}` {kind}, _class int, _each bigint, _k int",
    )
    minority = rows.join(classes.select(label, "_class"), label)
    found = nearest(
        minority.withColumnRenamed(id_col, "query_id"), minority.withColumnRenamed(id_col, "base_id"),
        k, dim, vector=vector, metric=metric, exclude_self=True, group="_class", **options,
    )

    more = F.array((F.lit(target) - F.col("n")) % F.col("n"))
    cut = cut_by_hash(minority.select(id_col, label), label, id_col, lambda s: s.select(label, more.alias("cuts")), "_seg")
    copies = F.col("_each") + F.when(F.col("_seg") == 0, 1).otherwise(0)
    spread = any((target - n) // n > 100_000 for n in short.values())
    drawn = numbered(cut.join(classes, label), copies, "copy", spread=spread)
    text = F.concat_ws(":", F.col(id_col).cast("string"), F.col("copy").cast("string"))
    drawn = drawn.select(
        id_col, label, "copy", (_hash_int(text, 1) % F.col("_k") + 1).cast("int").alias("rank"),
        ((_hash_int(text, 9) % 1_000_000) / F.lit(1e6)).alias("u"),
    )
    pairs = drawn.join(
        found.select(F.col("query_id").alias(id_col), "rank", F.col("base_id").alias("neighbour")), [id_col, "rank"]
    )
    here = rows.select(id_col, F.col(vector).alias("_x"))
    there = rows.select(F.col(id_col).alias("neighbour"), F.col(vector).alias("_y"))
    sparse = isinstance(df.schema[vector].dataType, T.StructType)
    return pairs.join(here, id_col).join(there, "neighbour").select(
        id_col, "copy", "neighbour", "u", label, interpolate(F.col("_x"), F.col("_y"), F.col("u"), sparse).alias(vector)
    )
