"""Components of similar items from locality-sensitive keys, without emitting all pairs.

items: (id binary, n int, keys array<bigint>, sample binary), one row for each
distinct item; payload: (id, runs binary), what a verification reads. Items that
share a key are candidates; a cheap comparison of samples comes before verification.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import slices
from opinara.llm.components import components
from opinara.session import saved

BLOCK = 256
#: Rows of a block in which all members of larger keys meet; a row is copied for each block that it meets.
LARGEST = 4096
_SLICE = 8192
_PAIRS = 1 << 18
_MATRIX = 4096


@dataclass
class Rules:
    """How two items compare.

    agreement(x, y): how many sampled values agree, by row (paired) or as a matrix;
    samples come as arrays made by `samples`. enough(n, m): the number that calls for
    verification. similar(a, b): the exact test on payloads. least: no two items link
    whose sizes n differ by more than this ratio. least_overlap: nor do two that share
    less than this part of the sum of their payloads' lengths.
    """

    samples: Callable[[list[bytes]], np.ndarray]
    agreement: Callable[[np.ndarray, np.ndarray, bool], np.ndarray]
    enough: Callable[[np.ndarray, np.ndarray], np.ndarray]
    similar: Callable[[np.ndarray, np.ndarray], bool]
    least: float
    least_overlap: float


def equal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many columns, a multiple of 8, two matrices agree, by row."""
    return np.bitwise_count((x == y).view(np.uint64)).sum(axis=1, dtype=np.int64)


def members_of(items: DataFrame) -> DataFrame:
    """(key, id, least): the items at keys that several items share, and the smallest of them."""
    keyed = items.select("id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("least")).where("size > 1")
    return saved(keyed.join(saved(shared.select("key", "least"), "link-keys"), "key").select("key", "id", "least"), "link-members")


def _agreeing(pairs: DataFrame, rules: Rules) -> DataFrame:
    """(a, b, same): the pairs whose samples agree enough."""

    def run(batches):
        for batch in slices(batches, 4096):
            column = lambda c: batch.column(batch.schema.names.index(c))  # noqa: B023, E731
            x, y = (rules.samples(column(c).to_pylist()) for c in ("sample_a", "sample_b"))
            n, m = (np.asarray(column(c)) for c in ("n_a", "n_b"))
            same = rules.agreement(x, y, False)
            found = pa.RecordBatch.from_arrays([column("a"), column("b"), pa.array(same.astype(np.int32))], ["a", "b", "same"])
            yield found.filter(pa.array(same >= rules.enough(n, m)))

    return pairs.mapInArrow(run, "a binary, b binary, same int")


def _verified(rules: Rules):
    def run(batches):
        for batch in slices(batches, 256):
            keep = [
                rules.similar(np.frombuffer(x, np.int32), np.frombuffer(y, np.int32))
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _starts(block: pa.Table) -> np.ndarray:
    """First row of each group; rows of a group lie side by side."""
    new = np.zeros(block.num_rows, bool)
    new[:1] = True
    for c in _GROUP:
        values = block[c].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 8192) -> Iterator[pa.Table]:
    """Tables of some `rows` rows or of one larger group, cut between groups only."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        block = pa.Table.from_batches(held).combine_chunks()
        cut = int(_starts(block)[-1])
        if cut:
            yield block.slice(0, cut)
        held = block.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _pairs(begin: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y): each row x with the n[x] rows from begin[x] on, in slices of some _PAIRS pairs."""
    total = np.cumsum(n)
    low = 0
    while low < len(n):
        high = max(low + 1, int(np.searchsorted(total, total[low] - n[low] + _PAIRS, "right")))
        some = n[low:high]
        x = np.repeat(np.arange(low, high), some)
        y = np.arange(len(x)) + np.repeat(begin[low:high] - np.cumsum(some) + some, some)
        if len(x):
            yield x, y
        low = high


def _candidates(block: pa.Table, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs within groups, of different components, that agree enough, how much, and the components.

    A pair counts at its first common key only. Rows of a group lie side by side. The pairs
    of all small groups are compared in one go, those of a large one as matrices.
    """
    column = lambda c: block[c].combine_chunks()
    first = _starts(block)
    group = np.repeat(np.arange(len(first)), np.diff(first, append=block.num_rows))
    within, i, j, chunk, side = (block[c].to_numpy() for c in ("within", "i", "j", "chunk", "side"))
    second = np.where(within, chunk != i, side == 1)
    comp = column("comp").dictionary_encode().indices.to_numpy()
    order = np.lexsort((comp, second, group))  # within a group, those that meet the rest come first
    key, n, second = block["key"].to_numpy()[order], block["n"].to_numpy()[order], second[order]
    sample = rules.samples(block["sample"].to_pylist())[order]
    keys = column("keys").flatten().to_numpy().reshape(len(order), -1)[order]
    mine = comp[order]
    ends = np.append(first[1:], len(order))
    among = (within & (i == j))[first]
    begin = np.where(among[group], np.arange(len(order)) + 1, (ends - np.add.reduceat(second.astype(np.int64), first))[group])
    partners = np.where(second, 0, ends[group] - begin)
    large = np.add.reduceat(partners, first) > _MATRIX
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def keep(x, y, same):
        ok = same >= rules.enough(n[x], n[y])
        x, y, same = x[ok], y[ok], same[ok]
        ok = keys[x, (keys[x] == keys[y]).argmax(axis=1)] == key[x]
        found.append((x[ok], y[ok], same[ok].astype(np.int64)))

    def may(x, y):
        return (mine[x] != mine[y]) & (np.minimum(n[x], n[y]) >= rules.least * np.maximum(n[x], n[y]))

    for x, y in _pairs(begin, np.where(large[group], 0, partners)):
        ok = may(x, y)
        if ok.any():
            x, y = x[ok], y[ok]
            keep(x, y, rules.agreement(sample[x], sample[y], False))
    for g in np.flatnonzero(large):
        stop = ends[g] if among[g] else begin[first[g]]
        at = first[g]
        while at < stop:
            low = begin[at]
            left = np.arange(at, min(stop, at + max(1, _PAIRS // (ends[g] - low + 1))))
            right = np.arange(low, ends[g])
            ok = may(left[:, None], right[None, :])
            if among[g]:
                ok &= left[:, None] < right[None, :]
            at = int(left[-1]) + 1
            rows, columns = ok.any(axis=1), ok.any(axis=0)
            left, right, ok = left[rows], right[columns], ok[np.ix_(rows, columns)]
            if len(left):
                same = rules.agreement(sample[left], sample[right], True)
                ok &= same >= rules.enough(n[left][:, None], n[right][None, :])
                x, y = np.nonzero(ok)
                keep(left[x], right[y], same[x, y])
    x, y, same = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    return order[x], order[y], same, comp


def _overlaps(runs: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many runs the pairs (x, y) of items share, repeats included: matrix products over slices of the runs."""
    rows = np.unique(np.concatenate([x, y]))
    keys = []
    for r in rows:
        ordered = np.sort(runs[r]).astype(np.int64)
        first = np.searchsorted(ordered, ordered)
        keys.append(ordered << 31 | (np.arange(len(ordered)) - first))
    owner = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
    code = np.unique(np.concatenate(keys), return_inverse=True)[1]
    shared = np.bincount(code)[code] > 1
    code, owner = code[shared], owner[shared]
    common = np.zeros((len(rows), len(rows)), np.float32)
    if len(code):
        code = np.unique(code, return_inverse=True)[1]
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        for low in range(0, int(code[-1]) + 1, _SLICE):
            part = slice(*np.searchsorted(code, [low, low + _SLICE]))
            has = np.zeros((len(rows), _SLICE), np.float32)
            has[owner[part], code[part] - low] = 1
            common += has @ has.T
    return common[np.searchsorted(rows, x), np.searchsorted(rows, y)]


def _parts(rows: Column, block: int) -> Column:
    return F.greatest(F.ceil(rows / block).cast("int"), F.lit(1))


def _chunk(parts: Column) -> Column:
    return F.pmod(F.xxhash64("id", "key"), parts).cast("int")


def _local_blocks(placed: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Each key's members dealt to chunks; only chunk mates meet."""
    cut = placed.join(sizes.select("key", "size"), "key").withColumn("chunk", _chunk(_parts(F.col("size"), block)))
    return cut.select("key", F.lit(True).alias("within"), F.col("chunk").alias("i"), F.col("chunk").alias("j"), "chunk", F.lit(1).alias("side"), "id", "comp")


def _all_blocks(placed: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Blocks in which all members of a key meet, but for those of its largest component among themselves."""
    cut = placed.join(sizes, "key")
    inner, outer = _parts(F.col("top"), block), _parts(F.col("size") - F.col("top"), block)
    cut = cut.withColumn("side", (F.col("comp") != F.col("largest")).cast("int"))
    cut = cut.withColumn("chunk", F.when(F.col("side") == 0, _chunk(inner)).otherwise(_chunk(outer)))
    to = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    out = ["key", "within", "i", "j", "chunk", "side", "id", "comp"]
    mains = cut.where("side = 0").withColumn("j", to(outer)).withColumn("i", F.col("chunk")).withColumn("within", F.lit(False))
    others = cut.where("side = 1")
    across = others.withColumn("i", to(inner)).withColumn("j", F.col("chunk")).withColumn("within", F.lit(False))
    among = others.withColumn("o", to(outer)).withColumn("i", F.least("chunk", "o")).withColumn("j", F.greatest("chunk", "o"))
    return mains.select(*out).union(across.select(*out)).union(among.withColumn("within", F.lit(True)).select(*out))


_GROUP = ["key", "within", "i", "j"]
_PLACE = "key bigint, within boolean, i int, j int, chunk int, side int, id binary, comp binary"


def similar_components(items: DataFrame, members: DataFrame, payload: DataFrame, rules: Rules) -> DataFrame:
    """(id, component) of the items that link with another one.

    1. Each item is verified against that of its keys' smallest items with which its
    samples agree best. 2. Members of keys that span several components meet in chunks of
    BLOCK, then, in keys of more than one such chunk, in chunks of LARGEST. All this is linear
    in the size of a key and joins most of a large group. 3. In keys of more than LARGEST
    members that still span several components all members meet in blocks, except those of
    the largest component with each other; in smaller keys they all have met. Pairs of
    different components whose samples agree are verified, the closest first, until their
    components are known to be one. No key
    is cut short.
    """
    side = lambda c: items.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sample").alias(f"sample_{c}"))
    stars = members.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    stars = stars.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * rules.least)
    stars = _agreeing(stars, rules).groupBy("a").agg(F.max(F.struct("same", "b")).alias("best")).select("a", "best.b")
    stars = saved(stars, "link-stars")
    runs = lambda c, name: payload.select(F.col("id").alias(c), F.col("runs").alias(name))
    linked = stars.join(runs("a", "x"), "a").join(runs("b", "y"), "b").select("a", "b", "x", "y")
    linked = saved(linked.mapInArrow(_verified(rules), "a binary, b binary"), "links")
    comps = components(linked)
    facts = items.select("id", "n", "keys", "sample")

    def near(batches):
        for block in _whole_groups(batches):
            x, y, _, _ = _candidates(block, rules)
            if len(x):
                close = block.take(pa.array(np.union1d(x, y).astype(np.int64))).select([*_GROUP, "chunk", "side", "id", "comp"])
                yield from close.to_batches()

    def link(block: pa.Table) -> pa.Table:
        x, y, same, comp = _candidates(block, rules)
        order = np.argsort(-same, kind="stable")
        x, y = x[order], y[order]
        seq = [np.frombuffer(r, np.int32) for r in block["runs"].to_pylist()]
        if len(x) > len(seq):
            size = np.array([len(r) for r in seq])
            enough = _overlaps(seq, x, y) >= rules.least_overlap * (size[x] + size[y]) - 1e-6
            x, y = x[enough], y[enough]
        root = list(range(int(comp.max()) + 1))

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        found = []
        for p, q in zip(x.tolist(), y.tolist(), strict=True):
            c, d = top(comp[p]), top(comp[q])
            if c != d and rules.similar(seq[p], seq[q]):
                root[max(c, d)] = min(c, d)
                found.append((p, q))
        ids = block["id"].to_pylist()
        return pa.table({"a": pa.array([ids[p] for p, _ in found], pa.binary()), "b": pa.array([ids[q] for _, q in found], pa.binary())})

    largest = max(LARGEST, BLOCK)
    for blocks, block in ((_local_blocks, BLOCK), (_local_blocks, largest), (_all_blocks, largest)):
        placed = saved(members.join(comps, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp")), "link-placed")
        counts = placed.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key")
        sizes = counts.agg(F.sum("n").alias("size"), F.max("n").alias("top"), F.max_by("comp", "n").alias("largest"), F.count("*").alias("comps"))
        sizes = saved(sizes.where("comps > 1").drop("comps"), "link-spanning")
        met = blocks(placed, sizes, block).join(facts, "id").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
        close = saved(met.mapInArrow(near, _PLACE), "link-close")
        if not close.isEmpty():
            full = close.join(facts, "id").join(payload, "id").groupBy(*_GROUP)
            more = saved(full.applyInArrow(link, "a binary, b binary"), "more-links")
            if not more.isEmpty():
                linked = linked.union(more)
                comps = components(linked)
        large = sizes.where(F.col("size") > block).select("key")
        if large.isEmpty():
            break
        members = members.join(large, "key", "left_semi")
    return comps
