"""Latent Dirichlet allocation for many segments and topic counts in one job.

The word-topic table is a DataFrame keyed by (segment, word); it is never brought to the
driver. Texts lie in blocks of rows of a segment, the larger the more texts there are: what a
pass shuffles is a row for each different word of each block, and a large block repeats its words
more often. A task still infers some texts of a block at a time. Words are numbered once, and
texts hold places in the sorted numbers of their block, so that no pass moves or compares
words. A row of the table lists the blocks that need its word, so that a pass only deals the rows
to those blocks, infers the topics of each block's texts in numpy and adds up what they give to
each word, which is batch variational Bayes: two shuffles of numbers, no join. Tables of a pass
are removed after the next. All topic counts are columns of the same table and
all segments share its key, so the number of jobs depends on the passes alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import discard, saved

_STEPS = 20
_BLOCKS = 32
_LEAST_ROWS, _MOST_ROWS = 1 << 10, 1 << 14
_LOT_CELLS = 1 << 19


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the log gamma function for positive arguments."""
    y = np.zeros_like(x)
    for shift in range(6):
        y -= 1.0 / (x + shift)
    z = x + 6.0
    w = 1.0 / (z * z)
    return y + np.log(z) - 0.5 / z - w * (1 / 12 - w * (1 / 120 - w * (1 / 252 - w * (1 / 240 - w / 132))))


def expected_topics(starts: np.ndarray, counts: np.ndarray, beta: np.ndarray, steps: int = _STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(topic weights of each text, share of each of its words): the variational E-step.

    Row i of beta is that of entry i of all bags; starts[d] is the first entry of text d,
    and every text has one. Each text takes the same number of steps, so its result does
    not depend on the others of its block.
    """
    k = beta.shape[1]
    sizes = np.diff(np.append(starts, len(counts)))
    rows = np.ascontiguousarray(beta.T)
    gamma = np.repeat((1.0 / k + np.add.reduceat(counts, starts) / k)[None, :], k, axis=0)
    for _ in range(steps):
        theta = np.exp(digamma(gamma) - digamma(gamma.sum(axis=0)))
        share = np.repeat(theta, sizes, axis=1) * rows
        share *= counts / (share.sum(axis=0) + 1e-100)
        gamma = 1.0 / k + np.add.reduceat(share, starts, axis=1)
    return gamma.T, share.T


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns of which some may be null, in segments without a name."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(other, reduce(lambda a, b: a & b, same, F.lit(True))).drop(*[f"_r_{c}" for c in on])


def _block_rows(n_rows: int) -> int:
    """Rows of a block: some ten blocks of a small input, as many as a task can hold of a large one."""
    return min(max(n_rows // _BLOCKS, _LEAST_ROWS), _MOST_ROWS)


def _bags(df: DataFrame, tokens: str, row_id: str, keys: Sequence[str], block_rows: int | None) -> DataFrame:
    """(keys..., row id, block, words, counts): distinct words of each text. Each block belongs to one segment."""
    sizes = saved(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "segment-sizes")
    size = block_rows or _block_rows(sizes.agg(F.sum("_n")).first()[0] or 0)
    parts = sizes.select(*keys, F.ceil(F.col("_n") / size).cast("int").alias("_parts"))
    blocks = parts.where("_parts > 0").select(*keys, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    blocks = saved(blocks.withColumn("_block", F.monotonically_increasing_id()), "segment-blocks")
    placed = _joined(df, parts, keys).withColumn("_part", F.pmod(F.xxhash64(row_id, F.lit(11)), F.col("_parts")).cast("int"))
    source = _joined(placed, blocks, [*keys, "_part"]).select(
        *keys, row_id, "_block", F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("_tokens")
    )
    kept = [source.schema[c] for c in (*keys, row_id, "_block")]
    lists = [T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]

    def count(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            found = column.flatten().dictionary_encode()
            names = len(found.dictionary)
            owner = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
            codes = found.indices.to_numpy(zero_copy_only=False)
            known = ~np.isnan(codes) if codes.dtype.kind == "f" else np.ones(len(codes), bool)
            pairs, n = np.unique(owner[known] * max(1, names) + codes[known].astype(np.int64), return_counts=True)
            offsets = pa.array(np.searchsorted(pairs // max(1, names), np.arange(len(column) + 1)), pa.int32())
            words = found.dictionary.take(pa.array(pairs % max(1, names)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32()))],
                [*batch.schema.names[:-1], "words", "counts"],
            )

    return saved(source.mapInArrow(count, T.StructType([*kept, *lists])), "bags")


@dataclass(frozen=True)
class TopicModels:
    """Fitted word-topic tables: one row for each (segment, word), one column for each topic of each count."""

    keys: tuple[str, ...]
    ks: tuple[int, ...]
    row_id: str
    bags: DataFrame
    needed: DataFrame
    words: DataFrame
    state: DataFrame

    def columns(self, k: int) -> range:
        at = self.ks.index(k)
        return range(sum(self.ks[:at]), sum(self.ks[: at + 1]))

    @property
    def width(self) -> int:
        return sum(self.ks)

    def top_words(self, n: int = 20) -> DataFrame:
        """(keys..., k, topic, rank, word, weight): the n likeliest words of every topic; ties by word."""
        totals = self.words.groupBy(*self.keys).agg(*[F.sum(f"l{j}").alias(f"t{j}") for j in range(self.width)])
        cells = F.array(
            *[
                F.struct(F.lit(k).alias("k"), F.lit(t).alias("topic"), (F.col(f"l{j}") / F.col(f"t{j}")).alias("weight"))
                for k in self.ks for t, j in enumerate(self.columns(k))
            ]
        )
        joined = self.words.join(totals, list(self.keys)) if self.keys else self.words.crossJoin(totals)
        long = joined.select(*self.keys, "word", F.explode(cells).alias("c")).select(*self.keys, "c.k", "c.topic", "word", "c.weight")
        order = Window.partitionBy(*self.keys, "k", "topic").orderBy(F.desc("weight"), "word")
        return long.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < n)

    def probabilities(self, k: int) -> DataFrame:
        """(row id, probs): topic probabilities of each text with words."""
        at, row_id = self.columns(k), self.row_id
        schema = T.StructType([self.bags.schema[self.row_id], T.StructField("probs", T.ArrayType(T.DoubleType()))])

        def infer(texts: pa.Table, table: pa.Table) -> pa.Table:
            starts, codes, counts, used = _entries(texts)
            found = [np.zeros((0, k))]
            if len(starts):
                beta = _beta(table)[1][:, at.start : at.stop]
                found += [expected_topics(first, n, beta[code])[0] for first, code, n in _some(starts, codes, counts)]
            gamma = np.concatenate(found)
            gamma /= gamma.sum(axis=1, keepdims=True)
            probs = pa.ListArray.from_arrays(pa.array(np.arange(len(gamma) + 1) * k, pa.int32()), pa.array(gamma.ravel()))
            return pa.table([texts[row_id].take(pa.array(used)), probs], names=[row_id, "probs"])

        return _paired(self.bags, _expected(self.state, self.width)).applyInArrow(infer, schema)


def _numbered(bags: DataFrame, needed: DataFrame, row_id: str) -> DataFrame:
    """(row id, block, codes, counts): for words their places among the sorted numbers of the block."""
    lists = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("codes", "counts")]
    schema = T.StructType([bags.schema[row_id], bags.schema["_block"], *lists])

    def encode(texts: pa.Table, table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table["_id"]))
        words = texts["words"].combine_chunks()
        found = pc.index_in(words.flatten(), value_set=table["word"].combine_chunks())
        offsets = pa.array(np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())]), pa.int32())
        codes = pa.ListArray.from_arrays(offsets, found)
        return pa.table([texts[row_id], texts["_block"], codes, texts["counts"]], names=schema.names)

    return _paired(bags.select(row_id, "_block", "words", "counts"), needed).applyInArrow(encode, schema)


def _entries(texts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each text with words, code and count of each entry, those texts)."""
    lists = texts["codes"].combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    counts = texts["counts"].combine_chunks().flatten().to_numpy().astype(np.float64)
    used = np.flatnonzero(sizes > 0)
    return np.cumsum(sizes[used]) - sizes[used], lists.flatten().to_numpy(), counts, used


def _some(starts: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries of a bounded number of texts at a time."""
    edges = np.append(starts, len(codes))
    for at in range(0, len(starts), _LEAST_ROWS):
        mine = edges[at : at + _LEAST_ROWS + 1]
        yield mine[:-1] - mine[0], codes[mine[0] : mine[-1]], counts[mine[0] : mine[-1]]


def _beta(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a block's words, sorted, and the rows of beta in this order."""
    ids = table["_id"].to_numpy()
    order = np.argsort(ids)
    column = table["beta"].combine_chunks()
    return ids[order], column.flatten().to_numpy().reshape(len(column), -1)[order]


def _expected(state: DataFrame, width: int) -> DataFrame:
    """(block, _id, _seg, beta): exp of the expected log probability of the words that each block needs.

    `state` holds (_id, _seg, _blocks, l0, l1...), _seg the number of the word's segment.
    """
    totals = state.groupBy("_seg").agg(F.array(*[F.sum(f"l{j}") for j in range(width)]).alias("_total"))
    rows = state.select("_id", "_seg", "_blocks", F.array(*[f"l{j}" for j in range(width)]).alias("_l")).join(totals, "_seg")

    @F.arrow_udf("array<double>")
    def beta(l: pa.Array, total: pa.Array) -> pa.Array:
        value = np.exp(digamma(l.flatten().to_numpy()) - digamma(total.flatten().to_numpy()))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(l) + 1) * width, pa.int32()), pa.array(value))

    rows = rows.select("_id", "_seg", "_blocks", beta("_l", "_total").alias("beta"))
    return rows.select(F.explode("_blocks").alias("_block"), "_id", "_seg", "beta")


def _paired(bags: DataFrame, table: DataFrame):
    return bags.groupBy("_block").cogroup(table.groupBy("_block"))


def _summed(given: DataFrame, pairs: int, prior: Sequence[float]) -> DataFrame:
    """(_id, _seg, _blocks, l0, l1...): sums over the blocks of a word, plus the prior, and its blocks.

    Words are added up in lots of some _LOT_CELLS numbers, without a sort by Spark.
    """
    width = len(prior)
    lots = max(1, -(-pairs * (width + 3) // _LOT_CELLS))
    fields = [T.StructField("_id", T.LongType()), T.StructField("_seg", T.LongType()), T.StructField("_blocks", T.ArrayType(T.LongType()))]
    schema = T.StructType([*fields, *[T.StructField(f"l{j}", T.DoubleType()) for j in range(width)]])

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [("_id", "ascending"), ("_block", "ascending")])).combine_chunks()
        ids = rows["_id"].to_numpy()
        starts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
        edges = pa.array(np.append(starts, len(ids)), pa.int32())
        sums = [pa.array(np.add.reduceat(rows[f"s{j}"].to_numpy(), starts) + p) for j, p in enumerate(prior)]
        first = pa.array(starts)
        blocks = pa.ListArray.from_arrays(edges, _chunk(rows["_block"]))
        return pa.table([rows["_id"].take(first), rows["_seg"].take(first), blocks, *sums], names=schema.names)

    return given.groupBy(F.pmod(F.xxhash64("_id"), F.lit(lots)).alias("_lot")).applyInArrow(add, schema)


def _chunk(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _first_weight(keys: Sequence[str], j: int, seed: int) -> Column:
    """Between 0.5 and 1.5, from the hash of segment, word and topic."""
    return 0.5 + F.pmod(F.xxhash64(*keys, "word", F.lit(seed), F.lit(j)), F.lit(1 << 20)) / float(1 << 20)


def fit_topics(
    df: DataFrame, tokens: str, row_id: str, keys: Sequence[str] = (), ks: Sequence[int] = (4,), passes: int = 10,
    seed: int = 42, block_rows: int | None = None,
) -> TopicModels:
    """Models with each of the topic counts `ks` for every segment, that is, combination of `keys`.

    The vocabulary of a segment is that of all its texts. Priors are 1 / k for topics and
    words. Texts without words take no part. Row ids have to be unique within df.
    """
    keys, ks = tuple(keys), tuple(ks)
    width = sum(ks)
    bags = _bags(df, tokens, row_id, keys, block_rows)
    named = bags.select(*keys, "_block", F.explode("words").alias("word"))
    names = named.groupBy(*keys, "word").agg(F.collect_set("_block").alias("_blocks"))
    names = saved(names.withColumn("_id", F.monotonically_increasing_id()), "words")
    segments = saved(names.select(*keys).distinct().withColumn("_seg", F.monotonically_increasing_id()), "segments-numbered")
    numbered = names.select(F.explode("_blocks").alias("_block"), "word", "_id")
    texts, needed = bags, numbered.select("_block", "_id")
    bags = saved(_numbered(texts, numbered, row_id), "numbered-bags")
    discard(texts)
    first = [_first_weight(keys, j, seed).alias(f"l{j}") for j in range(width)]
    state = saved(_joined(names.select(*keys, "_id", "_blocks", *first), segments, keys).drop(*keys), "word-topics")
    kinds = [T.StructField(c, T.LongType()) for c in ("_id", "_seg", "_block")]
    schema = T.StructType([*kinds, *[T.StructField(f"s{j}", T.DoubleType()) for j in range(width)]])
    edges = np.concatenate([[0], np.cumsum(ks)])

    def add_up(texts: pa.Table, table: pa.Table) -> pa.Table:
        starts, codes, counts, _ = _entries(texts)
        ids, rows = _beta(table)
        out = np.zeros((table.num_rows, width))
        if len(starts):
            for first, code, n in _some(starts, codes, counts):
                beta = rows[code]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    _, share = expected_topics(first, n, beta[:, a:b])
                    for j in range(a, b):
                        out[:, j] += np.bincount(code, weights=share[:, j - a], minlength=table.num_rows)
        alike = [pa.repeat(table[c][0], len(ids)) for c in ("_seg", "_block")] if len(ids) else [pa.array([], pa.int64())] * 2
        return pa.table([pa.array(ids), *alike, *[pa.array(out[:, j]) for j in range(width)]], names=schema.names)

    prior = [1.0 / k for k in ks for _ in range(k)]
    pairs = needed.count()
    for _ in range(passes):
        given = _paired(bags, _expected(state, width)).applyInArrow(add_up, schema)
        state, last = saved(_summed(given, pairs, prior), "word-topics"), state
        discard(last)
    words = names.drop("_blocks").join(state.drop("_blocks", "_seg"), "_id")
    return TopicModels(keys, ks, row_id, bags, needed, saved(words, "word-models") if passes else words, state)
