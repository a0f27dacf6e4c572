"""The most frequent word n-grams of a corpus, found level by level, and their weights.

An n-gram is not more frequent than its parts, so once `max_features` shorter terms are
known, the least frequent of them bounds what a longer one must reach. Words are counted
exactly. A longer n-gram made of frequent parts whose total is to reach a share e of all
tokens must reach it in at least one lot of a task's tokens, so a task names only those that hold e
of a lot; the few named are then counted exactly. No list of all n-grams is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import saved

_PIECE_ROWS = 1024
_LOT_TOKENS = 1 << 20


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(owner of each entry, entries) of a list column; a null list is empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(column)), sizes), column.flatten()


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of bounded size, so that what is derived from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, _PIECE_ROWS):
            yield batch.slice(at, _PIECE_ROWS)


def _in_pieces(column: pa.Array, of: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """What `of` gives for the column, taken in parts of bounded size."""
    parts = [of(column.slice(at, _PIECE_ROWS)) for at in range(0, max(1, len(column)), _PIECE_ROWS)]
    return pa.concat_arrays(parts)


def counted_terms(df: DataFrame, terms: str) -> DataFrame:
    """(term, ctf, df): occurrences and texts of each term of a list column, a row for each piece that holds it; no null term."""

    def count(batches):
        for batch in _pieces(batches):
            owner, flat = _lists(batch.column(0))
            coded = flat.dictionary_encode()
            held = pc.is_valid(coded).to_numpy(zero_copy_only=False)
            owner, codes, size = owner[held], pc.drop_null(coded.indices).to_numpy().astype(np.int64), len(coded.dictionary)
            texts = np.unique(owner * max(1, size) + codes) % max(1, size)
            sums = [pa.array(np.bincount(x, minlength=size).astype(np.int64)) for x in (codes, texts)]
            yield pa.RecordBatch.from_arrays([coded.dictionary, *sums], ["term", "ctf", "df"])

    return df.select(terms).mapInArrow(count, "term string, ctf bigint, df bigint")


def _runs(codes: np.ndarray, owner: np.ndarray, n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number in base `base`) of every run of n codes within one list, all of them >= 0."""
    m = max(0, len(codes) - n + 1)
    good = owner[:m] == owner[len(owner) - m :]
    out = np.zeros(m, np.int64)
    for k in range(n):
        part = codes[k : k + m]
        good = good & (part >= 0)
        out = out * base + part
    return owner[:m][good], out[good]


def _found(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each value in the sorted array `wanted`, -1 where it is not there."""
    if not len(wanted):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return np.where(wanted[at] == values, at, -1)


def _named(rows: DataFrame, n: int, base: int, parts: np.ndarray | None, share: float, least: int) -> np.ndarray:
    """n-grams that may occur `least` times in all: those that make up `share` of the tokens of some lot.

    `parts`, if given, are the (n - 1)-grams of which both ends have to be one.
    """

    def often(found, counts, tokens):
        (code,), (count,) = _merged(found, counts)
        kept = count >= share * tokens
        return pa.RecordBatch.from_arrays(
            [pa.array(code[kept]), pa.array(count[kept]), pa.array(np.full(int(kept.sum()), tokens))], ["code", "n", "tokens"]
        )

    def name(batches):
        empty = np.zeros(0, np.int64)
        found, counts, tokens = [empty], [empty], 0
        for batch in _pieces(batches):
            owner, flat = _lists(batch.column(0))
            tokens += len(flat)
            value = _grams(flat.to_numpy().astype(np.int64), owner, n, base, parts)[1]
            distinct, count = np.unique(value, return_counts=True)
            found.append(distinct)
            counts.append(count)
            if tokens >= _LOT_TOKENS:
                yield often(found, counts, tokens)
                found, counts, tokens = [empty], [empty], 0
            elif len(found) > 16:
                found, counts = _merged(found, counts)
        yield often(found, counts, tokens)

    seen = rows.mapInArrow(name, "code bigint, n bigint, tokens bigint").groupBy("code")
    total = least / share if share else 0.0
    # What a lot did not name may still hold up to its share.
    bound = F.sum("n") + share * (total - F.sum("tokens"))
    kept = seen.agg(bound.alias("bound")).where(F.col("bound") >= least * (1 - 1e-9)).select("code")
    return np.sort(np.array([r["code"] for r in kept.collect()], np.int64))


def _merged(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    distinct, at = np.unique(np.concatenate(found), return_inverse=True)
    return [distinct], [np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)]


def _grams(codes: np.ndarray, owner: np.ndarray, n: int, base: int, parts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    own, value = _runs(codes, owner, n, base)
    if parts is None:
        return own, value
    good = (_found(value // base, parts) >= 0) & (_found(value % base ** (n - 1), parts) >= 0)
    return own[good], value[good]


def _counted(rows: DataFrame, n: int, base: int, wanted: np.ndarray) -> list[tuple[int, int, int]]:
    """(code, corpus frequency, document frequency) of the wanted n-grams; a task sends each at most once."""

    def count(batches):
        ctf, df = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        for batch in _pieces(batches):
            owner, flat = _lists(batch.column(0))
            own, value = _runs(flat.to_numpy().astype(np.int64), owner, n, base)
            at = _found(value, wanted)
            hit = at >= 0
            ctf += np.bincount(at[hit], minlength=len(wanted))
            pairs = np.unique(own[hit] * max(1, len(wanted)) + at[hit])
            df += np.bincount(pairs % max(1, len(wanted)), minlength=len(wanted))
        used = np.flatnonzero(ctf)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(ctf[used]), pa.array(df[used])], ["at", "ctf", "df"])

    sums = rows.mapInArrow(count, "at bigint, ctf bigint, df bigint").groupBy("at").agg(F.sum("ctf").alias("ctf"), F.sum("df").alias("df"))
    return [(int(wanted[r["at"]]), r["ctf"], r["df"]) for r in sums.collect()]


@dataclass(frozen=True)
class Cut:
    """A vocabulary: the most frequent n-grams of low to high words that lie in min_df texts or more."""

    low: int
    high: int
    max_features: int
    min_df: int = 1

    def of(self, counts: Iterable[Count]) -> list[Count]:
        """The terms of the cut among counted ones, most frequent first, ties by term."""
        mine = [c for c in counts if self.low <= c.words <= self.high and c.df >= self.min_df]
        return sorted(mine, key=lambda c: (-c.ctf, c.term))[: self.max_features]


class Count(NamedTuple):
    """A term of some words, its corpus frequency and its document frequency."""

    term: str
    words: int
    ctf: int
    df: int


def gram_counts(df: DataFrame, tokens: str, word_stats: DataFrame, cuts: Sequence[Cut]) -> list[Count]:
    """Counts of all terms that belong to one of the cuts, which all have to begin with single words.

    `word_stats` holds (term, ctf, df) of all words. Terms join their words by a blank. The
    texts are coded once for all cuts; a level is counted down to the lowest bound of the cuts
    that reach it. The driver holds the words that reach it: max_features and ties with the last.
    """
    fewest, high = min(c.min_df for c in cuts), max(c.high for c in cuts)
    words = word_stats.where((F.col("df") >= fewest) & F.col("term").isNotNull())
    known: dict[str, Count] = {}
    for limit, min_df in sorted({(c.max_features, c.min_df) for c in cuts}):
        for r in words.where(F.col("df") >= min_df).orderBy(F.desc("ctf"), "term").limit(limit).collect():
            known[r["term"]] = Count(r["term"], 1, r["ctf"], r["df"])

    def bound(level: int) -> int:
        """Corpus frequency that a term of `level` words must reach to enter a cut."""
        full = [(c.of(known.values()), c.max_features) for c in cuts if c.high >= level]
        return min(found[-1].ctf if found and len(found) == limit else 1 for found, limit in full)

    if high > 1:
        names = sorted(r["term"] for r in words.where(F.col("ctf") >= bound(2)).select("term").collect())
        base = len(names) + 1
        table = pa.array(names, pa.string())

        def coded(lists: pa.Array) -> pa.Array:
            owner, flat = _lists(lists)
            codes = pc.fill_null(pc.index_in(flat, value_set=table), -1)
            return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(lists) + 1)), pa.int32()), codes)

        @F.arrow_udf("array<int>")
        def encode(lists: pa.Array) -> pa.Array:
            return _in_pieces(lists, coded)

        rows = saved(df.select(encode(F.col(tokens)).alias("codes")), "word-codes")
        total = rows.agg(F.sum(F.size("codes"))).first()[0] or 0
        found, parts = [], None
        for n in range(2, high + 1):
            least = bound(n)
            if n > 2:
                parts = np.sort(np.array([c for c, ctf, _ in found if ctf >= least], np.int64))
            named = _named(rows, n, base, parts, least / total if total else 0.0, least)
            found = [r for r in _counted(rows, n, base, named) if r[2] >= fewest and r[1] >= least]
            for code, ctf, d in found:
                term = " ".join(names[code // base**k % base] for k in range(n - 1, -1, -1))
                known[term] = Count(term, n, ctf, d)
    return list(known.values())


def frequent_ngrams(
    df: DataFrame, tokens: str, word_stats: DataFrame, ngram_range: tuple[int, int] = (1, 3), max_features: int = 7000, min_df: int = 1
) -> list[Count]:
    """Counts of the max_features most frequent n-grams; ties by term."""
    cut = Cut(*ngram_range, max_features, min_df)
    return cut.of(gram_counts(df, tokens, word_stats, [cut]))


def ngram_weights(tokens: Column, vocabulary: Sequence[str], idf: Sequence[float], sublinear: bool = True) -> Column:
    """Struct (indices, values): L2-normalised tf-idf of a token list over n-grams of a fixed vocabulary."""
    split = [t.split(" ") for t in vocabulary]
    names = sorted({w for ws in split for w in ws})
    code = {w: i for i, w in enumerate(names)}
    base = len(names) + 1
    table = pa.array(names, pa.string())
    levels = {}
    for n in sorted({len(ws) for ws in split}):
        mine = sorted((sum(code[w] * base ** (n - 1 - k) for k, w in enumerate(ws)), i) for i, ws in enumerate(split) if len(ws) == n)
        levels[n] = (np.array([c for c, _ in mine], np.int64), np.array([i for _, i in mine], np.int64))
    weight = np.array([*idf, 0.0])
    size = max(1, len(vocabulary))

    def weighed(lists: pa.Array) -> pa.Array:
        n_rows = len(lists)
        owner, flat = _lists(lists)
        codes = pc.fill_null(pc.index_in(flat, value_set=table), -1).to_numpy().astype(np.int64)
        keys = [np.zeros(0, np.int64)]
        for n, (wanted, index) in levels.items():
            own, value = _runs(codes, owner, n, base)
            at = _found(value, wanted)
            keys.append(own[at >= 0] * size + index[at[at >= 0]])
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        row, index = key // size, key % size
        value = (np.log(count) + 1.0 if sublinear else count) * weight[index]
        norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n_rows))
        value = np.divide(value, norm[row], out=np.zeros(len(value)), where=norm[row] > 0)
        offsets = pa.array(np.searchsorted(row, np.arange(n_rows + 1)), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(offsets, pa.array(index, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(value))],
            ["indices", "values"],
        )

    @F.arrow_udf(T.StructType([T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))]))
    def weigh(lists: pa.Array) -> pa.Array:
        return _in_pieces(lists, weighed)

    return weigh(tokens)
