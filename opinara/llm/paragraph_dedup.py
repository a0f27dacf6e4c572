"""Repeated passages by MinHash banding of paragraphs.

Paragraphs of at least 40 words are sets of runs of five words. Bands are tuned to a
recall, paragraphs that collide in a band are candidates, links are pairs with an exact
Jaccard similarity of 0.8 or more, and of each connected component of links the first
occurrence stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import slices, utf8
from opinara.llm.hashing import U, hashed_words, mix, powers, sequence_digests, shingles
from opinara.llm.linking import Rules, equal, members_of, similar_components
from opinara.session import saved

MIN_WORDS = 40
HASHES = 72
_MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=U)) | U(1)


def tuned_bands(least: float, max_miss: float, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have so that a pair at `least` is missed at most so often."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if (1 - least**rows) ** bands <= max_miss:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def signatures(runs: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """(texts with runs, HASHES) smallest hash of each text."""
    n = per_text[per_text > 0]
    begin = np.cumsum(n) - n
    out = np.empty((len(n), HASHES), U)
    for j in range(HASHES):
        out[:, j] = np.minimum.reduceat((runs * _MULTIPLIERS[j]) ^ (runs >> U(j % 23 + 7)), begin)
    return out


def distinct_runs(runs: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Number of different runs of each text, told apart by 32 bits as in the verification."""
    low = (runs & U(0xFFFFFFFF)) | (np.repeat(np.arange(len(per_text), dtype=U), per_text) << U(32))
    return np.bincount((np.unique(low) >> U(32)).astype(np.int64), minlength=len(per_text))


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(signature), bands), U)
    weights = powers(0x9E3779B97F4A7C15, rows + 1)[1:]
    for b in range(bands):
        keys[:, b] = mix((mix(signature[:, b * rows : (b + 1) * rows]) * weights).sum(axis=1, dtype=U) + U(b))
    return keys.view(np.int64)


def _samples(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, HASHES)


def _agreement(x: np.ndarray, y: np.ndarray, matrix: bool) -> np.ndarray:
    if not matrix:
        return equal(x, y)
    out = np.zeros((len(x), len(y)), np.uint8)
    for j in range(HASHES):
        out += x[:, j, None] == y[None, :, j]
    return out


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of sets as sorted arrays without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _paragraphs(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, version, paragraph, text): lines that are long enough to hold min_words words."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    lines = rows.where("text is not null").select("doc_id", "version", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.where(F.length("line") >= 2 * min_words - 1).select("doc_id", "version", "paragraph", F.col("line").alias("text"))


_SKETCH = "doc_id bigint, version bigint, paragraph int, id binary, n int, keys array<bigint>, sample binary"


def repeated_paragraphs(
    docs: DataFrame, least: float = 0.8, min_words: int = MIN_WORDS, max_miss: float = 4e-3
) -> DataFrame:
    """(doc_id, version, paragraph, first_doc_id, first_paragraph, members, removed).

    docs: (doc_id, text). A row for each paragraph (line, numbered from 0) that has
    company in its component; the occurrence with the smallest (doc_id, paragraph)
    is not removed, rows without doc_id come last. `version` is the hash of the text:
    rows repeated in full count as one document. Shorter paragraphs, null and empty
    texts are never listed. An empty table gives no rows.
    """
    bands, rows = tuned_bands(least, max_miss)
    paragraphs = _paragraphs(docs, min_words)

    def sketch(batches):
        for batch in slices(batches, 1024):
            words, counts = hashed_words(utf8(batch.column(3)))
            digest = sequence_digests(words, counts)
            runs, per_text = shingles(words, counts, digest)
            long = np.flatnonzero(counts >= min_words)
            if not len(long):
                continue
            distinct = distinct_runs(runs, per_text)
            signature = signatures(runs, per_text)[np.cumsum(per_text > 0)[long] - 1]
            keys = band_keys(signature, bands, rows)
            sample = (signature >> U(48)).astype(np.uint16)
            taken = batch.take(pa.array(long))
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column(0), taken.column(1), taken.column(2), pa.array([digest[k].tobytes() for k in long], pa.binary()),
                    pa.array(distinct[long].astype(np.int32)), pa.array(list(keys), pa.list_(pa.int64())),
                    pa.array([s.tobytes() for s in sample], pa.binary()),
                ],
                ["doc_id", "version", "paragraph", "id", "n", "keys", "sample"],
            )

    def sets(batches):
        for batch in slices(batches, 1024):
            words, counts = hashed_words(utf8(batch.column(0)))
            digest = sequence_digests(words, counts)
            runs, per_text = shingles(words, counts, digest)
            low = (runs & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            ends = np.cumsum(per_text)
            long = np.flatnonzero(counts >= min_words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest[k].tobytes() for k in long], pa.binary()),
                    pa.array([np.unique(low[ends[k] - per_text[k] : ends[k]]).tobytes() for k in long], pa.binary()),
                ],
                ["id", "runs"],
            )

    sketched = saved(paragraphs.mapInArrow(sketch, _SKETCH), "paragraph-sketches")
    items = saved(sketched.groupBy("id").agg(*[F.any_value(c).alias(c) for c in ("n", "keys", "sample")]), "paragraph-items")
    members = members_of(items)
    listed = members.select("id").distinct()
    payload = paragraphs.select("text").mapInArrow(sets, "id binary, runs binary")
    payload = saved(payload.join(listed, "id", "left_semi").dropDuplicates(["id"]), "paragraph-sets")
    # The smallest hashes estimate the similarity with a deviation of 0.05; at 0.8 fewer than 40 of 72 agree once in 10^6.
    rules = Rules(_samples, _agreement, lambda n, m: 40, lambda a, b: _jaccard(a, b) >= least, least, least / (1 + least))
    comps = similar_components(items, members, payload, rules)
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.col("version"), F.col("paragraph"))
    places = sketched.select("doc_id", "version", "paragraph", "id").dropDuplicates(["doc_id", "version", "paragraph"])
    placed = saved(places.join(comps, "id", "left").select("doc_id", "version", "paragraph", F.coalesce("component", "id").alias("comp")), "paragraph-places")
    groups = placed.groupBy("comp").agg(F.count("*").alias("members"), F.min(order).alias("first")).where("members > 1")
    joined = placed.join(saved(groups, "paragraph-groups"), "comp")
    first = F.col("first")
    return joined.select(
        "doc_id", "version", "paragraph",
        F.when(first["doc"] < 2**63 - 1, first["doc"]).alias("first_doc_id"), first["paragraph"].alias("first_paragraph"), "members",
        (order != first).alias("removed"),
    )


def without_repeated_paragraphs(docs: DataFrame, least: float = 0.8, min_words: int = MIN_WORDS) -> DataFrame:
    """docs, all columns and rows, with the removed paragraphs taken out of `text`."""
    gone = repeated_paragraphs(docs, least, min_words).where("removed").groupBy("doc_id", "version").agg(F.collect_set("paragraph").alias("gone"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc"),
        F.col("text").cast("string").alias("whole"),
    )
    same = F.col("doc").eqNullSafe(F.col("doc_id")) & (F.xxhash64("whole") == F.col("version"))
    joined = keyed.join(gone, same, "left")
    left = F.array_join(F.filter(F.split("whole", "\n"), lambda _, i: ~F.array_contains(F.col("gone"), i)), "\n")
    new = F.when(F.col("gone").isNotNull(), left).otherwise(F.col("whole")).alias("text")
    return joined.select(*[new if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
