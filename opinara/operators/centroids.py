"""K-Means for many segments, cluster counts and starts in one Lloyd pass.

Every task carries the centroids of all models and adds up, for each centroid, the rows
nearest to it; only these sums are shuffled. A pass has one task for each core, so that the sums
sent do not grow with the input, and reads only segments that still move. Seeding is k-means||, shared by all cluster
counts of a start. So the number of jobs depends on the iterations alone. The driver holds
the centroids, segments x starts x clusters x dimensions numbers; segments are taken
together as far as these stay below a bound, and group after group beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import saved

_SLICE = 512
_STATE_CELLS = 1 << 23
_SENT_CELLS = 1 << 16
_PART = "seg int, pos int, n array<double>, total array<double>"


def _dense(vectors: pa.Array, dim: int) -> np.ndarray:
    indices, values = vectors.field("indices"), vectors.field("values")
    out = np.zeros((len(vectors), dim))
    rows = np.repeat(np.arange(len(vectors)), indices.value_lengths().to_numpy())
    out[rows, indices.flatten().to_numpy()] = values.flatten().to_numpy()
    return out


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2.0 * (x @ c.T)
    return np.maximum(d, 0.0)


def _by_segment(batch: pa.RecordBatch, dim: int):
    """(segment, hashes, dense rows) of each segment in each slice of a batch of (seg, hash, vector)."""
    for at in range(0, batch.num_rows, _SLICE):
        part = batch.slice(at, _SLICE)
        seg = part.column(0).to_numpy()
        for s in np.unique(seg).tolist():
            pick = np.flatnonzero(seg == s)
            yield s, part.column(1).to_numpy()[pick], _dense(part.column(2).take(pa.array(pick)), dim)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    seg, pos, n, total = zip(*rows, strict=True) if rows else ((), (), (), ())
    lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (n, total)]
    return pa.RecordBatch.from_arrays([pa.array(seg, pa.int32()), pa.array(pos, pa.int32()), *lists], ["seg", "pos", "n", "total"])


def _read(found: pa.Table) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """The rows of a table of parts, with their lists as arrays."""
    lists = [found[c].combine_chunks() for c in ("n", "total")]
    return [
        (s, p, *[c[i].values.to_numpy(zero_copy_only=False) for c in lists])
        for i, (s, p) in enumerate(zip(found["seg"].to_pylist(), found["pos"].to_pylist(), strict=True))
    ]


def _per_core(rows: DataFrame) -> DataFrame:
    """The rows in no more partitions than there are cores: each sends sums as large as the models."""
    return rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def _added(rows: DataFrame, emit) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Sum of the rows that `emit(batches)` gives, by (seg, pos)."""

    def add(group: pa.Table) -> pa.Table:
        sums = []
        for name in ("n", "total"):
            column = group[name].combine_chunks()
            total = column.flatten().to_numpy().reshape(len(column), -1).sum(axis=0)
            sums.append(pa.array([total], pa.list_(pa.float64())))
        return pa.table([group["seg"][:1], group["pos"][:1], *sums], names=["seg", "pos", "n", "total"])

    return _read(_per_core(rows).mapInArrow(emit, _PART).groupBy("seg", "pos").applyInArrow(add, _PART).toArrow())


def _uniform(hashes: np.ndarray, *salts: int) -> np.ndarray:
    x = hashes.astype(np.uint64)
    for salt in salts:
        x = (x ^ np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)) / float(1 << 53)


def _seeds(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted candidates, by k-means++; repeated if there are fewer different ones."""
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    d = _squared(candidates, candidates)
    while len(chosen) < k:
        p = weights * d[:, chosen].min(axis=1)
        chosen.append(int(rng.choice(len(candidates), p=p / p.sum())) if p.sum() > 0 else chosen[0])
    return candidates[chosen].copy()


def _initial(rows: DataFrame, segments: int, ks: Sequence[int], n_init: int, dim: int, seed: int, rounds: int = 2):
    """{(segment, k, start): centroids} by k-means||, with 2 max(ks) expected candidates a round."""
    context = rows.sparkSession.sparkContext
    order = Window.partitionBy("seg").orderBy(F.xxhash64("hash", F.lit(seed)), "hash")
    first = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n_init).select("seg", "r", "vector").collect()
    pools: dict[tuple[int, int], list[np.ndarray]] = {}

    def add(s: int, start: int, vector) -> None:
        x = np.zeros(dim)
        x[list(vector["indices"])] = list(vector["values"])
        pools.setdefault((s, start), []).append(x)

    by_segment: dict[int, list] = {}
    for r in sorted(first, key=lambda r: (r["seg"], r["r"])):
        by_segment.setdefault(r["seg"], []).append(r["vector"])
    for s, vectors in by_segment.items():
        for start in range(n_init):
            add(s, start, vectors[start % len(vectors)])

    def cost_of(state):
        sent = context.broadcast(state)

        def emit(batches):
            total: dict[tuple[int, int], float] = {}
            for batch in batches:
                for s, _, x in _by_segment(batch, dim):
                    for start in range(n_init):
                        total[s, start] = total.get((s, start), 0.0) + float(_squared(x, sent.value[s, start]).min(axis=1).sum())
            yield _parts([(*key, [v], []) for key, v in total.items()])

        return {(s, start): float(n[0]) for s, start, n, _ in _added(rows, emit)}

    for turn in range(rounds):
        state = {key: np.array(v) for key, v in pools.items()}
        phi = cost_of(state)
        sent = context.broadcast((state, phi))

        def sample(batches, turn=turn, sent=sent):
            state, phi = sent.value
            for batch in batches:
                found = []
                for s, hashes, x in _by_segment(batch, dim):
                    for start in range(n_init):
                        if phi[s, start] > 0:
                            d = _squared(x, state[s, start]).min(axis=1)
                            hit = _uniform(hashes, seed, start, turn) < 2 * max(ks) * d / phi[s, start]
                            found += [(s, start, [float(h)], row) for h, row in zip(hashes[hit], x[hit], strict=True)]
                yield _parts(found)

        drawn = _read(rows.mapInArrow(sample, _PART).toArrow())
        for s, start, _, x in sorted(drawn, key=lambda r: (r[0], r[1], r[2][0], r[3].tolist())):
            pools[s, start].append(x)

    state = {key: np.unique(np.array(v), axis=0) for key, v in pools.items()}
    sent = context.broadcast(state)

    def weigh(batches):
        count = {key: np.zeros(len(c)) for key, c in sent.value.items()}
        for batch in batches:
            for s, _, x in _by_segment(batch, dim):
                for start in range(n_init):
                    near = _squared(x, sent.value[s, start]).argmin(axis=1)
                    count[s, start] += np.bincount(near, minlength=len(count[s, start]))
        yield _parts([(*key, c, []) for key, c in count.items() if c.any()])

    weights = {(s, start): n for s, start, n, _ in _added(rows, weigh)}
    return {
        (s, k, start): _seeds(c, weights[s, start], k, np.random.default_rng([seed, start, k]))
        for (s, start), c in state.items() for k in ks
    }


def _lloyd(rows: DataFrame, models: dict, dim: int, move: bool) -> tuple[dict, dict]:
    """(new centroids, none) of every model in one pass, or (the same ones, their inertia) if they are not to move."""
    keys: dict[int, list] = {}
    for key in sorted(models):
        keys.setdefault(key[0], []).append(key)
    # Models with the same number of clusters follow each other: (clusters, how many models) of each such run.
    runs = {s: [(k, sum(len(models[key]) == k for key in ks)) for k in sorted({len(models[key]) for key in ks})] for s, ks in keys.items()}
    layout = {s: (np.concatenate([models[key] for key in ks]), runs[s]) for s, ks in keys.items()}
    sent = rows.sparkSession.sparkContext.broadcast(layout)
    step = max(1, _SENT_CELLS // dim)

    def emit(batches):
        sums: dict[int, np.ndarray] = {}
        sizes: dict[int, np.ndarray] = {}
        costs: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, _, x in _by_segment(batch, dim):
                if s not in sent.value:
                    continue
                c, same = sent.value[s]
                if s not in sizes:
                    sizes[s], costs[s] = np.zeros(len(c)), np.zeros(sum(n for _, n in same))
                    sums[s] = np.zeros(c.shape if move else (0, 0))
                d = _squared(x, c)
                near = np.zeros(d.shape)
                at = model = 0
                for k, n in same:
                    apart = d[:, at : at + k * n].reshape(len(x), n, k)
                    if move:
                        places = at + np.arange(n) * k + apart.argmin(axis=2)
                        near[np.arange(len(x))[:, None], places] = 1.0
                    else:
                        costs[s][model : model + n] += apart.min(axis=2).sum(axis=0)
                    at, model = at + k * n, model + n
                if move:
                    sizes[s] += near.sum(axis=0)
                    sums[s] += near.T @ x
        if move:
            yield _parts([(s, p, sizes[s][p : p + step], sums[s][p : p + step].ravel()) for s in sums for p in range(0, len(sums[s]), step)])
        else:
            yield _parts([(s, 0, cost, []) for s, cost in costs.items()])

    fresh = {key: c.copy() for key, c in models.items()}
    cost = dict.fromkeys(models, 0.0)
    every = {s: (np.zeros(len(c)), np.zeros(c.shape)) for s, (c, _) in layout.items()} if move else {}
    moving = rows.where(F.col("seg").isin(*layout))
    for s, p, n, total in _added(moving, emit):
        if move:
            every[s][0][p : p + len(n)], every[s][1][p : p + len(n)] = n, total.reshape(len(n), dim)
        else:
            cost |= zip(keys[s], n.tolist(), strict=True)
    for s, (n, total) in every.items():
        at = 0
        for key in keys[s]:
            used = np.flatnonzero(n[at : at + len(fresh[key])])
            fresh[key][used] = total[at + used] / n[at + used, None]
            at += len(fresh[key])
    return fresh, cost


@dataclass(frozen=True)
class ClusterModels:
    """Centroids and inertia of each (segment, k, start); segments are tuples of key values."""

    keys: tuple[str, ...]
    centroids: dict[tuple, np.ndarray]
    inertia: dict[tuple, float]

    def best(self, segment: tuple, k: int) -> tuple:
        """The start with the least inertia; the first one of equals."""
        return min((key for key in self.centroids if key[0] == segment and key[1] == k), key=lambda key: (self.inertia[key], key[2]))

    def elbow(self) -> list[tuple]:
        """(key values..., k, inertia) of the best start."""
        pairs = sorted({key[:2] for key in self.centroids})
        return [(*s, k, self.inertia[self.best(s, k)]) for s, k in pairs]

    def assign(self, vector: Column, k: int) -> Column:
        """Number of the nearest centroid of the row's segment; of equal ones the lower; null for other segments."""
        chosen = {s: self.centroids[self.best(s, k)] for s in {key[0] for key in self.centroids}}
        code = segment_code(self.keys, sorted(chosen))
        tables = [chosen[s] for s in sorted(chosen)]

        @F.arrow_udf("int")
        def nearest(seg: pa.Array, v: pa.Array) -> pa.Array:
            seg = seg.to_numpy()
            out = np.full(len(v), -1, np.int32)
            for at in range(0, len(v), _SLICE):
                part = seg[at : at + _SLICE]
                for s in np.unique(part[part >= 0]).tolist():
                    pick = at + np.flatnonzero(part == s)
                    x = _dense(v.take(pa.array(pick)), tables[s].shape[1])
                    out[pick] = _squared(x, tables[s]).argmin(axis=1)
            return pa.array(out, mask=out < 0)

        return nearest(code, vector)


def segment_code(keys: Sequence[str], segments: Sequence[tuple]) -> Column:
    """Position of the row's key values in the list of segments, -1 if they are not there."""
    if not keys:
        return F.lit(0)
    code = F.lit(-1)
    for i, s in enumerate(segments):
        same = F.lit(True)
        for c, v in zip(keys, s, strict=True):
            same = same & F.col(c).eqNullSafe(F.lit(v))
        code = F.when(same, F.lit(i)).otherwise(code)
    return code


def fit_clusters(
    features: DataFrame, row_id: str, dim: int, keys: Sequence[str] = (), ks: Sequence[int] = (4,), n_init: int = 10,
    seed: int = 42, max_iter: int = 300, tol: float = 1e-4, vector: str = "features",
) -> ClusterModels:
    """K-Means with each k of `ks` and `n_init` starts for every segment (combination of `keys`).

    `vector` is a struct (indices, values) below `dim`. A model stops when no centroid
    moves by more than `tol`; a centroid without rows stays where it is.
    """
    keys = tuple(keys)
    segments = sorted(tuple(r) for r in features.select(*keys).distinct().collect()) if keys else [()]
    per_segment = max(1, n_init * sum(ks) * dim)
    together = max(1, _STATE_CELLS // per_segment)
    centroids, inertia = {}, {}
    for at in range(0, len(segments), together):
        group = segments[at : at + together]
        rows = features.select(segment_code(keys, group).alias("seg"), F.xxhash64(row_id).alias("hash"), F.col(vector).alias("vector"))
        # In order of segments, a slice of rows mostly belongs to one of them.
        rows = saved(rows.where("seg >= 0").sortWithinPartitions("seg"), "cluster-rows")
        models = _initial(rows, len(group), ks, n_init, dim, seed)
        active = dict(models)
        for _ in range(max_iter):
            if not active:
                break
            fresh, _ = _lloyd(rows, active, dim, move=True)
            moved = {key: float(np.sqrt(((fresh[key] - active[key]) ** 2).sum(axis=1).max())) for key in active}
            models.update(fresh)
            active = {key: fresh[key] for key in fresh if moved[key] > tol}
        _, cost = _lloyd(rows, models, dim, move=False)
        centroids |= {(group[s], k, start): c for (s, k, start), c in models.items()}
        inertia |= {(group[s], k, start): v for (s, k, start), v in cost.items()}
    return ClusterModels(keys, centroids, inertia)
