"""Topic coherence from word co-occurrence.

The topic words are a bounded list (topics x top words), so they travel to the tasks. A
task reads its reviews once and adds up, for all topics of all models and segments
together, how many windows hold each word and each wanted pair; only these sums are
shuffled. Every coherence is then read from the one table of counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import saved

EPSILON = 1e-12
_WINDOWS = 4096
_ROWS = 1024


class _Words:
    """The topic words of one segment: which pairs are wanted, and the words of each model."""

    def __init__(self, models: dict[tuple, dict[object, list[str]]]):
        self.words = sorted({w for topics in models.values() for ws in topics.values() for w in ws})
        at = {w: i for i, w in enumerate(self.words)}
        pairs = {(i, i) for i in range(len(self.words))}
        self.models = list(models)
        self.member = np.zeros((len(self.words), len(models)), np.float32)
        for m, topics in enumerate(models.values()):
            for ws in topics.values():
                codes = sorted({at[w] for w in ws})
                pairs.update(combinations(codes, 2))
                self.member[codes, m] = 1
        self.pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)


def _windows_of(codes: np.ndarray, places: np.ndarray, size: int, window: int) -> np.ndarray:
    """Sum over the sliding windows of a long text of the outer product of the words they hold."""
    words, own = np.unique(codes, return_inverse=True)
    last = size - window
    total = np.zeros((len(words), len(words)))
    for first in range(0, last + 1, _WINDOWS):
        n = min(_WINDOWS, last + 1 - first)
        edges = np.zeros((n + 1, len(words)), np.int32)
        low = np.clip(places - (window - 1) - first, 0, n)
        high = np.clip(places + 1 - first, 0, n)
        np.add.at(edges, (low, own), 1)
        np.add.at(edges, (high, own), -1)
        held = (np.cumsum(edges[:n], axis=0) > 0).astype(np.float32)
        total += held.T @ held
    return total


def _count(batch: pa.RecordBatch, segments: list[_Words], together: list[np.ndarray], totals: list[np.ndarray], window: int | None) -> None:
    """Add a batch of (segment number, tokens) to the co-occurrences and the windows of each model."""
    seg = batch.column(0).to_numpy()
    tokens = batch.column(1)
    sizes = np.nan_to_num(tokens.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    owner = np.repeat(np.arange(len(seg)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = tokens.flatten()
    for s in np.unique(seg[seg >= 0]).tolist():
        known = segments[s]
        mine = np.flatnonzero(seg[owner] == s)
        codes = pc.index_in(flat.take(pa.array(mine)), value_set=pa.array(known.words, pa.string()))
        hit = mine[codes.is_valid().to_numpy(zero_copy_only=False)]
        code = codes.drop_null().to_numpy().astype(np.int64)
        texts, row = np.unique(owner[hit], return_inverse=True)
        held = np.zeros((len(texts), len(known.words)), np.float32)
        held[row, code] = 1
        last = np.zeros(len(texts), np.int64) if window is None else np.maximum(sizes[texts] - window, 0)
        totals[s] += (last + 1) @ (held @ known.member > 0)
        one = held[last == 0]
        together[s] += one.T @ one
        starts = np.searchsorted(row, np.arange(len(texts) + 1))
        for k in np.flatnonzero(last).tolist():
            at = slice(starts[k], starts[k + 1])
            words = np.unique(code[at])
            together[s][np.ix_(words, words)] += _windows_of(code[at], place[hit[at]], int(sizes[texts[k]]), window)


def _counts(df: DataFrame, topics: DataFrame, keys: Sequence[str], models: Sequence[str], tokens: str, window: int | None):
    """(keys..., a, b, n) for the wanted word pairs, a <= b, and (keys..., models..., n) windows.

    `topics` holds (keys..., models..., topic, i, w). The windows of a model are those of the
    reviews that hold any of its words.
    """
    listed: dict[tuple, dict] = {}
    for r in topics.select(*keys, *models, "topic", "w").collect():
        values = tuple(r)
        model = listed.setdefault(values[: len(keys)], {}).setdefault(values[len(keys) : -2], {})
        model.setdefault(values[-2], []).append(values[-1])
    names = sorted(listed)
    segments = [_Words(listed[s]) for s in names]
    code = F.lit(0 if names else -1)
    if keys:
        code = F.lit(-1)
        for i, s in enumerate(names):
            same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(keys, s, strict=True)]
            code = F.when(F.forall(F.array(*same), lambda x: x), i).otherwise(code)

    def emit(batches):
        together = [np.zeros((len(s.words), len(s.words))) for s in segments]
        totals = [np.zeros(len(s.models)) for s in segments]
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                _count(batch.slice(at, _ROWS), segments, together, totals, window)
        seg, a, b, n = [], [], [], []
        for i, s in enumerate(segments):
            pairs = together[i][s.pairs[:, 0], s.pairs[:, 1]]
            used = np.flatnonzero(pairs)
            seg += [i] * (len(used) + len(s.models))
            a += [*s.pairs[used, 0].tolist(), *[-1] * len(s.models)]
            b += [*s.pairs[used, 1].tolist(), *range(len(s.models))]
            n += [*pairs[used].astype(np.int64).tolist(), *totals[i].astype(np.int64).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(seg, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(n, pa.int64())], ["seg", "a", "b", "n"]
        )

    rows = df.select(code.alias("seg"), F.col(tokens).alias("tokens")).mapInArrow(emit, "seg int, a int, b int, n bigint")
    sums = saved(rows.groupBy("seg", "a", "b").agg(F.sum("n").alias("n")), "word-pairs")
    spark = df.sparkSession
    key_fields = [topics.schema[c] for c in keys]
    words = spark.createDataFrame(
        [(i, k, *names[i], w) for i, s in enumerate(segments) for k, w in enumerate(s.words)],
        T.StructType([T.StructField("seg", T.IntegerType()), T.StructField("code", T.IntegerType()), *key_fields, T.StructField("w", T.StringType())]),
    )
    left = words.select("seg", *keys, F.col("code").alias("a"), F.col("w").alias("wa"))
    right = words.select("seg", F.col("code").alias("b"), F.col("w").alias("wb"))
    counts = sums.where("a >= 0").join(left, ["seg", "a"]).join(right, ["seg", "b"])
    counts = counts.select(*keys, F.col("wa").alias("a"), F.col("wb").alias("b"), "n")
    model_rows = spark.createDataFrame(
        [(i, k, *names[i], *m) for i, s in enumerate(segments) for k, m in enumerate(s.models)],
        T.StructType(
            [T.StructField("seg", T.IntegerType()), T.StructField("b", T.IntegerType()), *key_fields, *[topics.schema[c] for c in models]]
        ),
    )
    totals = sums.where("a < 0").join(model_rows, ["seg", "b"]).select(*keys, *models, F.col("n").alias("n_windows"))
    return counts, totals


def topic_rows(df: DataFrame, topics: Sequence[Sequence[str]]) -> DataFrame:
    """(topic, i, w) for lists of words."""
    rows = [(t, i, w) for t, words in enumerate(topics) for i, w in enumerate(words)]
    return df.sparkSession.createDataFrame(rows, "topic int, i int, w string")


def window_counts(df: DataFrame, topics: Sequence[Sequence[str]], tokens: str = "tokens", window: int = 110) -> tuple[DataFrame, DataFrame]:
    """(a, b, n): sliding windows that hold both words; and the number of windows.

    A review of length L has max(1, L - window + 1) windows. Pairs are those within a
    topic, each word with itself included; pairs that never meet may be absent.
    """
    return _counts(df, topic_rows(df, topics), (), (), tokens, window)


def _joint(topics: DataFrame, counts: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., i, j, n_i, n_j, n_ij) over the ordered word pairs of each topic."""
    left = topics.select(*by, "i", F.col("w").alias("wi"))
    right = topics.select(*by, F.col("i").alias("j"), F.col("w").alias("wj"))
    pairs = left.join(right, list(by)).withColumns({"a": F.least("wi", "wj"), "b": F.greatest("wi", "wj")})
    joint = pairs.join(counts, [*keys, "a", "b"], "left").select(*by, "i", "j", F.coalesce("n", F.lit(0)).alias("n_ij"))
    alone = joint.where("i = j").select(*by, "i", F.col("n_ij").alias("n_i"))
    return joint.join(alone, [*by, "i"]).join(
        alone.select(*by, F.col("i").alias("j"), F.col("n_i").alias("n_j")), [*by, "j"]
    )


def coherence_sweep(
    df: DataFrame, topics: DataFrame, keys: Sequence[str] = (), models: Sequence[str] = (), tokens: str = "tokens", window: int = 110
) -> DataFrame:
    """c_v of every topic of every model of every segment, from one pass over df.

    `topics` holds (keys..., models..., topic, i, w): the words w of a topic by rank i. The
    reviews of a segment are the rows of df with its key values. Gives (keys..., models...,
    topic, coherence): the mean cosine of each word's NPMI vector with the sum of them all.
    """
    keys, by = tuple(keys), (*keys, *models, "topic")
    counts, totals = _counts(df, topics, keys, models, tokens, window)
    j = _joint(topics, counts, keys, by)
    j = j.join(F.broadcast(totals), [*keys, *models]) if keys or models else j.crossJoin(F.broadcast(totals))
    n = F.col("n_windows")
    p = F.col("n_ij") / n
    ratio = F.log((p + EPSILON) / (F.col("n_i") / n * (F.col("n_j") / n))) / -F.log(p + EPSILON)
    npmi = j.select(*by, "i", "j", F.when((F.col("n_i") > 0) & (F.col("n_j") > 0), ratio).otherwise(0.0).alias("v"))
    total_v = npmi.groupBy(*by, "j").agg(F.sum("v").alias("s"))
    dots = npmi.join(total_v, [*by, "j"]).groupBy(*by, "i").agg(
        F.sum(F.col("v") * F.col("s")).alias("vs"), F.sum(F.col("v") * F.col("v")).alias("vv"),
        F.sum(F.col("s") * F.col("s")).alias("ss"),
    )
    norm = F.sqrt(F.col("vv") * F.col("ss"))
    cos = F.when(norm > 0, F.col("vs") / norm).otherwise(0.0)
    return dots.groupBy(*by).agg(F.avg(cos).alias("coherence"))


def coherence_cv(df: DataFrame, topics: Sequence[Sequence[str]], tokens: str = "tokens", window: int = 110) -> DataFrame:
    """c_v of each topic, given as lists of words."""
    return coherence_sweep(df, topic_rows(df, topics), tokens=tokens, window=window)


def coherence_umass(df: DataFrame, topics: Sequence[Sequence[str]], tokens: str = "tokens") -> DataFrame:
    """Mean log((D(w_i, w_j) + 1) / D(w_j)) over word pairs with j ranked before i."""
    rows = topic_rows(df, topics)
    counts, _ = _counts(df, rows, (), (), tokens, None)
    j = _joint(rows, counts, (), ("topic",)).where("j < i and n_j > 0")
    return j.groupBy("topic").agg(F.avg(F.log((F.col("n_ij") + 1.0) / F.col("n_j"))).alias("coherence"))
