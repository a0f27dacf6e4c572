"""Passages of equal words inside and across lines, beside the paragraphs that are lines.

A text's words, line ends left out of account, are covered by windows of 32 words that
begin where a run of five words has the smallest hash of 20 neighbouring runs. So windows
begin at the same places of a passage in every text, and one of them lies wholly inside
each stretch of 51 words or more. A changed word takes five of the 28 runs of such a
window, which leaves its Jaccard similarity below 0.8: windows are similar only if they
are equal. Equal windows of several documents are linked by their digests, overlapping
ones grow to a span, and spans that share a window form a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import slices, utf8
from opinara.llm.components import components
from opinara.llm.hashing import U, hashed_words, mix, positions, powers
from opinara.session import saved

WORDS = 32
RUN = 5
SPREAD = 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ROWS = "doc bigint, version bigint, at int, digest bigint"


def anchors(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the smallest run, the first of equals, of every SPREAD neighbouring runs of one text."""
    n = len(words) - RUN - SPREAD + 2
    if n <= 0:
        return np.zeros(0, np.int64)
    order = np.zeros(len(words) - RUN + 1, U)
    for k in range(RUN):
        order = mix(order + words[k : k + len(order)])
    best = np.arange(len(order))
    reach = 1
    while reach < SPREAD:
        step = min(reach, SPREAD - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(order[left] <= order[right], left, right)
        reach += step
    whole = positions(counts)[:n] + SPREAD + RUN - 1 <= np.repeat(counts, counts)[:n]
    found = best[:n][whole]
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def windows(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the text, digest) of each window that begins at an anchor."""
    at = anchors(words, counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = positions(counts)
    at = at[place[at] + WORDS <= counts[owner[at]]]
    sums = np.concatenate([np.zeros(1, U), np.cumsum(words * powers(_BASE, len(words)), dtype=U)])
    digest = mix((sums[at + WORDS] - sums[at]) * powers(_INVERSE, len(words))[at])
    return owner[at], place[at], digest.view(np.int64)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, version, from_word, to_word, first_doc_id, first_word, members, removed).

    docs: (doc_id, text). A row for each span of words [from_word, to_word) whose windows
    occur in more than one document. `members` counts the spans of its component, and
    `first_...` names the smallest of them by (doc_id, from_word). A span is not removed if
    it holds the first occurrence of each of its windows; rows without doc_id come last.
    `version` is the hash of the text: rows repeated in full count as one document, equal
    texts under several ids as several. Windows are compared by 64-bit digests. Null and
    empty texts and those of fewer than 32 words have no spans; an empty table gives none.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text")
    )

    def cut(batches):
        for batch in slices(batches, 128):
            owner, at, digest = windows(*hashed_words(utf8(batch.column(2))))
            doc, version = (batch.column(k).take(pa.array(owner)) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [doc, version, pa.array(at.astype(np.int32)), pa.array(digest)], ["doc", "version", "at", "digest"]
            )

    cuts = saved(rows.where("text is not null").mapInArrow(cut, _ROWS), "passage-windows")
    where = F.struct("doc", "version", "at")
    low, high = F.col("low"), F.col("high")
    shared = cuts.groupBy("digest").agg(F.min(where).alias("low"), F.max(where).alias("high"))
    shared = shared.where((low["doc"] != high["doc"]) | (low["version"] != high["version"])).select("digest", "low")
    hits = cuts.join(saved(shared, "passage-digests"), "digest").dropDuplicates(["doc", "version", "at"])
    in_text = Window.partitionBy("doc", "version").orderBy("at")
    before = F.lag("at").over(in_text)
    hits = hits.select("doc", "version", "at", "digest", (where != low).alias("later"), before.alias("before"), F.lag("digest").over(in_text).alias("last"))
    overlaps = F.coalesce(F.col("at") - F.col("before") < WORDS, F.lit(False))
    hits = hits.withColumn("span", F.sum((~overlaps).cast("int")).over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
    hits = saved(hits.withColumn("joined", overlaps), "passage-hits")
    comps = components(hits.where("joined").select(F.col("last").alias("a"), F.col("digest").alias("b")))
    spans = hits.groupBy("doc", "version", "span").agg(
        F.min("at").alias("from_word"), (F.max("at") + WORDS).alias("to_word"), F.min("digest").alias("id"), F.bool_or("later").alias("removed")
    )
    placed = spans.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = saved(placed.drop("id", "span"), "passage-spans")
    order = F.struct("doc", "version", "from_word")
    groups = placed.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.min(order).alias("first"))
    known = lambda c: F.when(c < 2**63 - 1, c)
    return placed.join(saved(groups, "passage-groups"), "component").select(
        known(F.col("doc")).alias("doc_id"), "version", "from_word", "to_word", known(F.col("first")["doc"]).alias("first_doc_id"),
        F.col("first")["from_word"].alias("first_word"), "members", "removed",
    )
