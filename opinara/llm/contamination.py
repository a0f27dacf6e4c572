"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's windows.

The windows of all benchmark items, as sequences of word numbers, go into one
automaton. Every task scans each of its texts once; word positions lead back to
character offsets in the original text. There is no shuffle.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import WORD_PATTERN, add_column, slices, utf8, words_of

HIT_TYPE = "struct<n_words: bigint, n_hit: bigint, items: array<bigint>, spans: array<struct<from: int, to: int>>>"

_HIT_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.int64())),
        ("spans", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
    ]
)


def windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(item_id, words): each run of `size` words of an item, or all words of a shorter one."""

    def cut(batches):
        for batch in slices(batches):
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = words_of(text)
                for start in range(max(1, len(words) - size + 1) if words else 0):
                    ids.append(item)
                    found.append(b" ".join(words[start : start + size]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["item_id", "words"])

    narrow = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(cut, "item_id bigint, words binary").distinct()


def _automaton(rows: list[tuple[int | None, bytes]]):
    """Word numbers and the automaton whose values are (length, item ids)."""
    numbers: dict[bytes, int] = {}
    items: dict[tuple[int, ...], set] = {}
    for item, words in rows:
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in words.split(b" "))
        items.setdefault(key, set()).add(item)
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, owners in items.items():
        machine.add_word(key, (len(key), tuple(owners)))
    machine.make_automaton()
    return numbers, machine


def _scan(words: list[bytes], numbers: dict[bytes, int], machine) -> tuple[list[list[int]], set]:
    """Hit word intervals, in order and merged, and the items found."""
    intervals: list[list[int]] = []
    items: set = set()
    for end, (length, owners) in machine.iter(tuple(numbers.get(w, 0) for w in words)):
        start = end - length + 1
        while intervals and start <= intervals[-1][1] + 1:
            start = min(start, intervals.pop()[0])
        intervals.append([start, end])
        items.update(owners)
    return intervals, items


def _merged(intervals: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", out: str = "contamination",
    max_windows: int = 200_000,
) -> DataFrame:
    """All rows of docs with what the benchmark and their whole text share.

    `out` is struct(n_words, n_hit, items, spans): words, words inside a window of
    the benchmark, sorted ids of the items with such windows, and the merged hits as
    character offsets [from, to) in the original text. Null and empty texts have no
    words and no hits; repeated rows stay and get equal results; an empty benchmark
    hits nothing; an item without id hits words but is not listed; items with the
    same id count as one; a column named as `out` is replaced.

    An automaton holds at most `max_windows` windows (some 100 MB in a task). A
    larger benchmark is cut into several, all sent to the tasks, which build and
    scan with one after the other for every batch.
    """
    spark = docs.sparkSession
    found = windows(benchmark, size)
    parts = -(-max(1, found.count()) // max_windows)
    sent = []
    for part in range(parts):
        mine = found.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == part) if parts > 1 else found
        sent.append(spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in mine.toLocalIterator()]))
    pattern = re.compile(WORD_PATTERN)

    def build():
        ready = _automaton(sent[0].value) if parts == 1 else None

        def compute(batch: pa.RecordBatch) -> pa.Array:
            texts = utf8(batch.column(0))
            hits: list[list[list[int]]] = [[] for _ in texts]
            owners: list[set] = [set() for _ in texts]
            counts = [0] * len(texts)
            for block in sent:
                numbers, machine = ready or _automaton(block.value)
                for k, raw in enumerate(texts):
                    words = words_of(raw)
                    counts[k] = len(words)
                    if words and numbers:
                        intervals, items = _scan(words, numbers, machine)
                        hits[k] += intervals
                        owners[k] |= items
            rows = []
            for raw, n, intervals, items in zip(texts, counts, hits, owners, strict=True):
                spans = []
                merged = _merged(intervals)
                if merged:
                    at = [m.span() for m in pattern.finditer(raw.decode("utf-8", "replace"))]
                    spans = [{"from": at[a][0], "to": at[b][1]} for a, b in merged]
                rows.append(
                    {
                        "n_words": n,
                        "n_hit": sum(b - a + 1 for a, b in merged),
                        "items": sorted(i for i in items if i is not None),
                        "spans": spans,
                    }
                )
            return pa.array(rows, _HIT_ARROW)

        return compute

    return add_column(docs, out, HIT_TYPE, build, [text])
