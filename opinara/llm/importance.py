"""Resampling towards a target text distribution by hashed n-gram features.

Every run of words of the wanted sizes is a feature and falls, by the CRC-32 of its bytes,
into one of a fixed number of buckets. The distinct features of a batch are grouped by
equal length into two-dimensional byte arrays, whose CRCs advance one column at a time for
all rows at once. Bucket counts of corpus and target are added up task by task; a bucket's
gain is its log ratio, a document's weight the sum of its gains. Documents are drawn by the
largest weight plus Gumbel noise from a keyed hash of the id, that is, without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import WORD_BYTES, add_column, slices, utf8
from opinara.session import saved

_PIECE = 1 << 19
_WIDEST = 1024


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_TABLE = _crc_table()


def crc_by_length(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte strings data[start : start + length].

    A column step costs as much for one row as for a hundred, so strings of over 1,024
    bytes, of which there are few, go to zlib one by one.
    """
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    sizes, counts = np.unique(lengths, return_counts=True)
    ends = np.cumsum(counts)
    for size, end, count in zip(sizes.tolist(), ends.tolist(), counts.tolist(), strict=True):
        rows = order[end - count : end]
        if size > _WIDEST:
            out[rows] = [zlib.crc32(data[s : s + size]) for s in starts[rows].tolist()]
            continue
        columns = data[np.arange(size)[:, None] + starts[rows]]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in columns:
            crc = _TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
        out[rows] = ~crc
    return out


def _units(texts: list[bytes], lead: int) -> Iterator[tuple[int, bytes, int]]:
    """(text, words, carried): long texts in parts that begin with the last `lead` words before them."""
    for k, text in enumerate(texts):
        data = text.translate(WORD_BYTES)
        at, tail = 0, []
        while True:
            cut = len(data)
            if cut - at > _PIECE:
                cut = data.rfind(b" ", at, at + _PIECE)
                if cut < 0:
                    cut = data.find(b" ", at)
                if cut < 0:
                    cut = len(data)
            part = data[at:cut]
            yield k, b" ".join([*tail, part]), len(tail)
            if cut == len(data):
                break
            at = cut + 1
            if lead:
                tail = [*tail, *part.rsplit(None, lead)[-lead:]][-lead:] if part.strip() else tail


def _grouped(texts: list[bytes], lead: int) -> Iterator[list[tuple[int, bytes, int]]]:
    group, held = [], 0
    for unit in _units(texts, lead):
        group.append(unit)
        held += len(unit[1])
        if held >= _PIECE:
            yield group
            group, held = [], 0
    if group:
        yield group


def _buckets(units: list[tuple[int, bytes, int]], sizes: tuple[int, int], buckets: int):
    """(text of each new word, text of each feature, bucket of each feature)."""
    owner_of = np.array([u[0] for u in units])
    carried = np.array([u[2] for u in units])
    edges = np.cumsum([0] + [len(u[1]) + 1 for u in units])
    raw = np.frombuffer(b" ".join(u[1] for u in units) + b" ", np.uint8)
    inside = raw != 32
    before = np.concatenate([[False], inside[:-1]])
    kept = inside | before
    place = np.cumsum(kept) - 1
    starts = np.flatnonzero(inside & ~before)
    unit = np.searchsorted(edges, starts, "right") - 1
    first = np.searchsorted(unit, np.arange(len(units)))
    local = np.arange(len(starts)) - first[unit]
    data = raw[kept]
    begin = place[starts]
    end = place[np.flatnonzero(~inside & before)]
    owners, found = [], []
    for n in range(sizes[0], sizes[1] + 1):
        head = np.arange(max(0, len(begin) - n + 1))
        head = head[(unit[head] == unit[head + n - 1]) & (local[head] + n - 1 >= carried[unit[head]])]
        length = end[head + n - 1] - begin[head]
        offsets = np.concatenate([[0], np.cumsum(length)])
        flat = data[np.repeat(begin[head] - offsets[:-1], length) + np.arange(offsets[-1])]
        features = pa.Array.from_buffers(
            pa.large_binary(), len(head), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)]
        ).dictionary_encode()
        distinct = features.dictionary
        at = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
        body = np.frombuffer(distinct.buffers()[2], np.uint8) if len(distinct) else np.zeros(0, np.uint8)
        bucket = crc_by_length(body, at[:-1], np.diff(at)).astype(np.int64) % buckets
        found.append(bucket[features.indices.to_numpy()])
        owners.append(owner_of[unit[head]])
    fresh = unit[local >= carried[unit]] if len(unit) else unit
    return owner_of[fresh], np.concatenate(owners), np.concatenate(found)


def bucket_counts(df: DataFrame, text: str = "text", sizes: tuple[int, int] = (1, 1), buckets: int = 10_000) -> np.ndarray:
    """Features of all texts in each bucket. A task sends at most one row for each bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for units in _grouped(utf8(batch.column(0)), sizes[1] - 1):
                total += np.bincount(_buckets(units, sizes, buckets)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    parts = df.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of target and corpus, in thousandths, rounded down."""
    n = len(target)
    up = (target + 1.0) * float(int(corpus.sum()) + n)
    down = (corpus + 1.0) * float(int(target.sum()) + n)
    return np.floor(1000.0 * np.log(up / down)).astype(np.int64)


def importance(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", out: str = "importance",
    sizes: tuple[int, int] = (1, 1), buckets: int = 10_000, seed: str = "2024",
) -> DataFrame:
    """All rows of docs with struct(n_words, n_features, weight, score) in `out`.

    Features are all runs of sizes[0] to sizes[1] consecutive words, repeats counted; the
    corpus distribution is that of docs, the target's that of the texts of `target`. `score`
    is the weight plus Gumbel noise, in thousandths, from sha256 of "seed:id".

    Null and empty texts have no words, no features and weight 0; a null id counts as empty
    text in the hash. Repeated rows stay, with equal scores. An empty docs gives no rows, an
    empty target an even distribution. A column named as `out` is replaced. Long texts are
    read in parts of half a megabyte, with the words that features share across a cut.
    """
    gains = bucket_gains(bucket_counts(target, text, sizes, buckets), bucket_counts(docs, text, sizes, buckets))

    def build():
        def compute(batch: pa.RecordBatch) -> pa.Array:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for units in _grouped(utf8(batch.column(0)), sizes[1] - 1):
                word_of, feature_of, bucket = _buckets(units, sizes, buckets)
                words += np.bincount(word_of, minlength=n)
                features += np.bincount(feature_of, minlength=n)
                np.add.at(weight, feature_of, gains[bucket])
            return pa.StructArray.from_arrays(
                [pa.array(c) for c in (words, features, weight)], ["n_words", "n_features", "weight"]
            )

        return compute

    found = add_column(docs, out, "struct<n_words: bigint, n_features: bigint, weight: bigint>", build, [text])
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000.0 * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))
    return found.withColumn(out, F.col(f"`{out}`").withField("score", F.col(f"`{out}`")["weight"] + noise))


def drawn(
    scored: DataFrame, percent: int = 10, least_words: int = 20, id: str = "doc_id", out: str = "importance"
) -> DataFrame:
    """`scored` with `rank` added to its struct `out`: 1, 2, ... for the rows drawn, else null.

    Drawn is the given share, rounded down, of the rows of at least `least_words` words, by
    the highest score; ties go to the smaller id, nulls last, equal rows in any order. The
    order is a distributed sort: rows get their place in their part of it, and the sizes of
    the parts add the rest, so no task sees more than one part. All columns of `scored`
    travel through that sort: select the ones to keep first.
    """
    row, at = F.struct(*[F.col(f"`{c}`") for c in scored.columns]), F.col(f"`{out}`")
    base = saved(
        scored.select(
            row.alias("row"), at["score"].alias("score"), F.col(f"`{id}`").alias("id"),
            F.coalesce(at["n_words"] >= least_words, F.lit(False)).alias("fit"), F.monotonically_increasing_id().alias("tie"),
        ),
        "scored",
    )
    ordered = base.where("fit").orderBy(F.desc("score"), F.asc_nulls_last("id"), "tie")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = saved(ordered.select("row", F.spark_partition_id().alias("part"), place.alias("place")), "ordered")
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy().orderBy("part")
    parts = parts.select(
        "part", (F.sum("n").over(whole) - F.col("n")).alias("before"),
        F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).alias("wanted"),
    )
    rank = F.col("before") + F.col("place") + 1
    ranked = ordered.join(F.broadcast(parts), "part").select("row", F.when(rank <= F.col("wanted"), rank).alias("rank"))
    others = base.where("not fit").select("row", F.lit(None).cast("bigint").alias("rank"))
    both = ranked.unionByName(others)
    kept = [F.col(f"row.`{c}`").alias(c) for c in scored.columns if c != out]
    return both.select(*kept, F.col(f"row.`{out}`").withField("rank", F.col("rank")).alias(out))
