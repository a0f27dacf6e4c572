"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its runs of five words. For each of several hash
functions the two smallest occurrence-labelled runs are taken and kept in text
order; texts that agree on one such pair are candidates. A candidate pair is a link
if the runs, aligned in order, agree to 0.8 or more: LCS / (n + m - LCS). Classes
are the connected components of links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.alignment import sequence_similarity
from opinara.llm.common import add_column, slices, unused, utf8
from opinara.llm.linking import Rules, equal, members_of, similar_components
from opinara.llm.hashing import U, hashed_words, labelled, mix, positions, sequence_digests, shingles
from opinara.session import saved

SKETCHES = 16
_PLACE_BITS = U(24)
_PLACES = (U(1) << _PLACE_BITS) - U(1)
_NONE = U(0xFFFFFFFFFFFFFFFF)
#: Of the 32 sampled runs, as many must agree before a pair is aligned; at similarity
#: 0.8 about 25 do, and fewer than 14 with a probability below 1e-5.
AGREE = 14

_SKETCH_DDL = "struct<digest: binary, n: int, keys: array<bigint>, sample: binary>"
_SKETCH_ARROW = pa.struct([("digest", pa.binary()), ("n", pa.int32()), ("keys", pa.list_(pa.int64())), ("sample", pa.binary())])


def digests_of(texts: list[bytes]) -> list[bytes | None]:
    """16 bytes that equal texts (as word sequences) share; None without words."""
    words, counts = hashed_words(texts)
    both = sequence_digests(words, counts)
    return [both[k].tobytes() if counts[k] else None for k in range(len(texts))]


def sketch(texts: list[bytes]) -> list[dict | None]:
    """Digest, number of runs, one key for each hash function, and the sampled runs."""
    words, counts = hashed_words(texts)
    digest = sequence_digests(words, counts)
    runs, per_text = shingles(words, counts, digest)
    label = labelled(runs, per_text)
    full = np.flatnonzero(per_text)
    out: list[dict | None] = [None] * len(texts)
    if not len(full):
        return out
    n = per_text[full]
    begin = np.cumsum(n) - n
    place = np.minimum(positions(n).astype(U), _PLACES)
    keys = np.empty((len(full), SKETCHES), U)
    sample = np.empty((len(full), SKETCHES, 2), np.uint32)
    for j in range(SKETCHES):
        v = (mix(label ^ mix(np.array([j + 1], U))) & ~_PLACES) | place
        first = np.minimum.reduceat(v, begin)
        v[begin + np.minimum((first & _PLACES).astype(np.int64), n - 1)] = _NONE
        second = np.minimum.reduceat(v, begin)
        two = n > 1
        at = [begin + np.minimum((m & _PLACES).astype(np.int64), n - 1) for m in (first, second)]
        lo, hi = np.minimum(at[0], at[1]), np.maximum(at[0], at[1])
        pair = label[lo] * U(0x9E3779B97F4A7C15) + np.where(two, label[hi] * U(0xC2B2AE3D27D4EB4F), U(7))
        keys[:, j] = mix(pair + U(j))
        sample[:, j, 0] = (first >> U(32)).astype(np.uint32)
        sample[:, j, 1] = np.where(two, (second >> U(32)).astype(np.uint32), np.uint32(0))
    for k, t in enumerate(full):
        out[t] = {"digest": digest[t].tobytes(), "n": int(n[k]), "keys": keys[k].view(np.int64), "sample": sample[k].tobytes()}
    return out


def _samples(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, SKETCHES, 2)


def _agreement(x: np.ndarray, y: np.ndarray, matrix: bool) -> np.ndarray:
    """How many sampled runs two sets of samples share."""
    if not matrix:
        return sum(equal(x[:, :, p], y[:, :, q]) for p in (0, 1) for q in (0, 1))
    out = np.zeros((len(x), len(y)), np.uint8)
    for j in range(SKETCHES):
        for p in (0, 1):
            for q in (0, 1):
                out += x[:, j, p, None] == y[None, :, j, q]
    return out


def _enough(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How many sampled runs must agree; a text with one run has only one in each sketch."""
    return np.where(np.minimum(n, m) > 1, AGREE, AGREE // 2)


def _runs_of(docs: DataFrame) -> DataFrame:
    """(id, runs): the digest and the run hashes (int32) of every text that has words."""

    def run(batches):
        for batch in slices(batches):
            texts = utf8(batch.column(0))
            words, counts = hashed_words(texts)
            digest = sequence_digests(words, counts)
            found, per_text = shingles(words, counts, digest)
            low = (found & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            ends = np.cumsum(per_text)
            full = [k for k in range(len(texts)) if counts[k]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest[k].tobytes() for k in full], pa.binary()),
                    pa.array([low[ends[k] - per_text[k] : ends[k]].tobytes() for k in full], pa.binary()),
                ],
                ["id", "runs"],
            )

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "id binary, runs binary")


def order_minhash_classes(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(digest, class_id, members, comp): a row for each word sequence that has company.

    docs: (doc_id, text). class_id is the smallest doc_id of the class, members its
    number of rows, comp its smallest digest. Word sequences that occur once and link with nothing are not
    listed, nor are null texts and texts without words, which link with nothing.

    Equal word sequences become one item first; linking.similar_components does the rest.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def build():
        return lambda batch: pa.array(sketch(utf8(batch.column(0))), _SKETCH_ARROW)

    sketched = saved(add_column(rows, "s", _SKETCH_DDL, build, ["text"]).where("s.n > 0").select("doc_id", "s.*"), "omh-sketch")
    items = saved(
        sketched.groupBy(F.col("digest").alias("id")).agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
            *[F.any_value(c).alias(c) for c in ("n", "keys", "sample")],
        ),
        "omh-items",
    )
    members = members_of(items)
    listed = members.select("id").distinct()
    runs = saved(_runs_of(docs).join(listed, "id", "left_semi").dropDuplicates(["id"]), "omh-runs")
    rules = Rules(_samples, _agreement, _enough, lambda a, b: sequence_similarity(a, b, least) > 0, least, least / (1 + least))
    comps = similar_components(items, members, runs, rules)
    grouped = items.join(comps, "id", "left").select("id", "doc_id", "copies", F.coalesce("component", "id").alias("comp"))
    classes = saved(grouped.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("members")).where("members > 1"), "omh-classes")
    return saved(grouped.join(classes, "comp").select(F.col("id").alias("digest"), "class_id", "members", "comp"), "omh-result")


def with_digest(docs: DataFrame, out: str = "digest", text: str = "text") -> DataFrame:
    """docs with the digest that order_minhash_classes uses (null without words)."""
    return add_column(docs, out, "binary", lambda: lambda batch: pa.array(digests_of(utf8(batch.column(0))), pa.binary()), [text])


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, class_id, members, kept): one row for each row of docs (doc_id, text).

    class_id is the smallest doc_id of the class; a document that links with nothing,
    also one without words, is its own class. kept marks the row whose doc_id is the
    class id. Rows repeated with their doc_id are one document and share all columns.
    Rows without doc_id belong to the class of their text and are kept only if the
    whole class has no doc_id. An empty table gives no rows.
    """
    ids = with_digest(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    joined = ids.select("doc_id", "digest").join(order_minhash_classes(docs, least), "digest", "left")
    grouped = F.col("members").isNotNull()
    class_id = F.when(grouped, F.col("class_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        class_id.alias("class_id"),
        F.coalesce("members", F.lit(1)).cast("long").alias("members"),
        class_id.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def deduplicated(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of docs, all columns, without near-duplicates: one row of each class stays."""
    names = docs.columns
    digest, class_id, comp = (unused(names, n) for n in ("omh_digest", "omh_class", "omh_comp"))
    joined = with_digest(docs, digest)
    classes = order_minhash_classes(docs, least).select(
        F.col("digest").alias(digest), F.col("class_id").alias(class_id), F.col("comp").alias(comp)
    )
    joined = joined.join(classes, digest, "left")
    alone = F.col(comp).isNull()
    columns = [F.col(f"`{c}`") for c in names]
    first = F.col(class_id).eqNullSafe(F.col("doc_id").cast("long"))
    chosen = joined.where(~alone & first).select(F.col(comp), F.struct(*columns).alias(class_id))
    # Rows repeated with their id, or rows without id, are still several here.
    one = chosen.groupBy(comp).agg(F.first(class_id).alias(class_id))
    return joined.where(alone).select(*columns).union(one.select(*[F.col(f"{class_id}.`{c}`").alias(c) for c in names]))
