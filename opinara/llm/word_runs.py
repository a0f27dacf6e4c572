"""Periodic runs of words, found on a grammar of the texts.

A run is a longest stretch of words that repeats itself at a distance q, its smallest
period, and is at least 2 q long. The words of many texts become one Re-Pair grammar
(`grammar`). A run lies inside the lowest nonterminal that covers it and crosses the
boundary between that nonterminal's two parts; so each nonterminal is searched for
stretches across its boundary once, however often it is derived, and what it holds is
copied to all positions of its derivations. Stretches that a longer one of the same
period covers are dropped; the rest are the runs. There is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opinara.llm.common import add_column, utf8
from opinara.llm.grammar import rounds
from opinara.llm.hashing import mix

RUNS_TYPE = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"

_BLOCK = 1 << 17
_STEP = 1 << 20
_NEAR = 64


def _grams(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` tokens from each position on, three places to the right; ends never match."""
    n = len(tokens)
    sums = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        sums = mix(sums + tokens[k : k + len(sums)].astype(np.uint64) + np.uint64(1))
    edge = np.arange(n + 6, dtype=np.uint64)
    edge[size : size + len(sums)] = sums
    return edge


def _matching(tokens: np.ndarray, x: np.ndarray, y: np.ndarray, room: np.ndarray, sign: int) -> np.ndarray:
    """How many tokens from x and y on (backwards for sign -1) are equal, up to `room`."""
    got = np.zeros(len(x), np.int64)
    active = np.flatnonzero(room > 0)
    while len(active):
        width = int(np.clip(16384 // len(active), 8, 4096))
        steps = got[active, None] + np.arange(width)
        inside = steps < room[active, None]
        steps = sign * np.minimum(steps, room[active, None] - 1)
        equal = inside & (tokens[x[active, None] + steps] == tokens[y[active, None] + steps])
        whole = equal.all(axis=1)
        got[active] += np.where(whole, width, equal.argmin(axis=1))
        active = active[whole]
    return got


def _candidates(grams: np.ndarray, size: int, first: np.ndarray, left: np.ndarray, right: np.ndarray):
    """(rule, anchor, q) for which a run of period q across the rule's boundary is possible.

    Such a run holds q tokens after the boundary or q before it, [anchor, anchor + q), and
    equal neighbourhoods of at least `size` tokens on one side of both its ends.
    """
    half = (left + right) // 2
    for before in (False, True):
        count = np.minimum(left if before else right, half)
        ends = np.cumsum(count)
        starts = ends - count
        total = int(ends[-1]) if len(ends) else 0
        for x in range(0, total, _STEP):
            y = min(total, x + _STEP)
            a, b = np.searchsorted(ends, x, "right"), np.searchsorted(starts, y, "left")
            part = np.minimum(ends[a:b], y) - np.maximum(starts[a:b], x)
            rule = np.repeat(np.arange(a, b), part)
            q = np.arange(x, y) - starts[rule] + 1
            boundary = first[rule] + left[rule]
            anchor = boundary - q if before else boundary
            hit = (grams[anchor + size] == grams[anchor + q + size]) | (grams[anchor] == grams[anchor + q])
            yield rule[hit], anchor[hit], q[hit]


def _boundary_runs(tokens, grams, size, least, first, left, right):
    """(rule, start, end, q): stretches inside the first place of each rule that cross its boundary."""
    found = [c for c in _candidates(grams, size, first, left, right) if len(c[0])]
    if not found:
        return None
    rule, anchor, q = (np.concatenate(c) for c in zip(*found, strict=True))
    low, high = first[rule], first[rule] + left[rule] + right[rule]

    def stretch(pick, limit):
        x, y = anchor[pick], anchor[pick] + q[pick]
        back, ahead = x - low[pick], high[pick] - y
        if limit:
            back, ahead = np.minimum(back, limit), np.minimum(ahead, limit)
        return x - _matching(tokens, x - 1, y - 1, back, -1), y + _matching(tokens, x, y, ahead, 1)

    everything = np.arange(len(rule))
    start, end = stretch(everything, _NEAR)
    far = ((anchor - start == _NEAR) & (start > low)) | ((end - anchor - q == _NEAR) & (end < high))
    # Long stretches: the smallest q of a rule first; its multiples inside that stretch are the same run.
    todo = np.flatnonzero(far)
    todo = todo[np.lexsort((q[todo], rule[todo]))]
    done = [np.flatnonzero(~far)]
    while len(todo):
        head = np.concatenate([[True], rule[todo][1:] != rule[todo][:-1]])
        now = todo[head]
        start[now], end[now] = stretch(now, 0)
        done.append(now)
        base = now[np.cumsum(head) - 1]
        same = (q[todo] % q[base] == 0) & (anchor[todo] >= start[base]) & (anchor[todo] + q[todo] <= end[base])
        todo = todo[~head & ~same]
    pick = np.concatenate(done)
    pick = pick[end[pick] - start[pick] >= np.maximum(least, 2 * q[pick])]
    pick = pick[np.lexsort((q[pick], end[pick], start[pick], rule[pick]))]
    key = np.stack([rule[pick], start[pick], end[pick]])
    new = np.ones(len(pick), bool)
    new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
    pick = pick[new]
    return rule[pick], start[pick], end[pick], q[pick]


def find_runs(tokens: np.ndarray, sizes: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run in token sequences that stand one after the other."""
    size = max(1, min(3, (-(-least // 2) + 1) // 2))
    grams = _grams(tokens, size)
    starts, ends, periods = ([np.zeros(0, np.int64)] for _ in range(3))
    for rules in rounds(tokens, sizes):
        wide = np.flatnonzero(rules.left + rules.right >= max(2, least))
        found = _boundary_runs(tokens, grams, size, least, rules.first[wide], rules.left[wide], rules.right[wide])
        if found is None:
            continue
        rule, start, end, q = found
        rule = wide[rule]
        begin = np.searchsorted(rules.rule, rule, "left")
        copies = np.searchsorted(rules.rule, rule, "right") - begin
        each = np.repeat(np.arange(len(rule)), copies)
        place = np.arange(len(each)) - np.repeat(np.cumsum(copies) - copies, copies) + begin[each]
        move = rules.at[place] - rules.first[rule[each]]
        starts.append(start[each] + move)
        ends.append(end[each] + move)
        periods.append(q[each])
    start, end, q = np.concatenate(starts), np.concatenate(ends), np.concatenate(periods)
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    # Of one period, keep what reaches beyond all that starts before it.
    reach = q * (len(tokens) + 1) + end
    longest = np.maximum.accumulate(reach) if len(reach) else reach
    kept = np.ones(len(reach), bool)
    kept[1:] = reach[1:] > longest[:-1]
    start, end, q = start[kept], end[kept], q[kept]
    order = np.lexsort((q, start))
    return start[order], end[order] - start[order], q[order]


def _blocks(words: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about _BLOCK words together."""
    first, held = 0, 0
    for k, w in enumerate(words):
        held += len(w)
        if held >= _BLOCK:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(words):
        yield first, len(words)


def _described(words: list[list[bytes]], least: int) -> list[pa.Array]:
    """n_words, runs and the collapsed text of each word list."""
    sizes = np.array([len(w) for w in words], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    flat = pa.array([w for ws in words for w in ws], pa.large_binary())
    tokens = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = find_runs(tokens, sizes, least)
    owner = np.searchsorted(edges, start, "right") - 1
    change = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change)[:-1] == 0
    changed = set(owner.tolist())
    collapsed = [
        b" ".join([w for w, k in zip(ws, kept[edges[i] : edges[i + 1]].tolist(), strict=True) if k] if i in changed else ws)
        for i, ws in enumerate(words)
    ]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])
    runs = pa.StructArray.from_arrays(
        [pa.array(start - edges[owner], pa.int64()), pa.array(length, pa.int64()), pa.array(period, pa.int64())],
        ["start", "length", "period"],
    )
    return [
        pa.array(sizes, pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    ]


def word_runs(docs: DataFrame, text: str = "text", out: str = "word_runs", least: int = 12) -> DataFrame:
    """All rows of docs with the periodic runs of at least `least` words in their whole text.

    `out` is struct(n_words, runs, collapsed). Words are what white space (blank, tab, line
    feed, vertical tab, form feed, carriage return) separates, numbered from 0. `runs` is an
    array of (start, length, period) by start, then period; `collapsed` is the text without
    the words that any run contains after its first `period` words, joined by one blank.

    Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows
    stay, each with its runs. No text is cut: a task holds about 131,072 words at a time, or
    one longer text. An empty table gives no rows; a column named as `out` is replaced.
    """

    def build():
        def compute(batch: pa.RecordBatch) -> pa.Array:
            words = [t.split() for t in utf8(batch.column(0))]
            parts = [_described(words[a:b], least) for a, b in _blocks(words)] or [_described([], least)]
            columns = [pa.concat_arrays(c) for c in zip(*parts, strict=True)]
            return pa.StructArray.from_arrays(columns, ["n_words", "runs", "collapsed"])

        return compute

    return add_column(docs, out, RUNS_TYPE, build, [text])
