"""Line deduplication by a segment-partition edit join.

Two lines are the same if they are equal or a few edits apart: one edit for each 20
characters of the shorter one, at most two. A line within k edits of another keeps
one of the other's k + 1 segments whole, near its place. So every line publishes its
segments and asks for the substrings of itself at which a segment of a line of its
length or somewhat shorter could be; lines that meet are compared by banded
bit-parallel edit distance. Lines of fewer than 20 characters are the same only if
they are equal. Of each class of lines the first occurrence stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.components import components
from opinara.llm.common import slices
from opinara.session import saved

MIN_CHARS = 20
MAX_EDITS = 2
BLOCK = 512
_PART_BYTES = 32 << 20
_MAP_WORDS = 1 << 19
_LONG = 4096
# Odd multipliers of the substring hash, any will do.
_BASE, _SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_ENTRY = [("key", "<u8"), ("line", "<i8")]


def allowed(length: int) -> int:
    """Edits allowed between a line of this length and a longer one."""
    return min(MAX_EDITS, length // MIN_CHARS)


def segments(length: int, k: int) -> list[tuple[int, int]]:
    """(start, end) of k + 1 even segments; the last ones are longer by one."""
    base, extra = divmod(length, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = base + (i >= k + 1 - extra)
        out.append((at, at + size))
        at += size
    return out


def probes(length: int) -> list[tuple[int, int, int]]:
    """(seed, start, end) of all substrings under which a line asks for partners.

    A partner is as long or up to its allowed edits shorter. If its segment i is kept
    and none before it, the edits to its left number at most i and those to its right
    at most k - i, which bounds the shift of the substring.
    """
    out = []
    for other in range(max(MIN_CHARS, length - MAX_EDITS), length + 1):
        k, gap = allowed(other), length - other
        if gap > k:
            continue
        for i, (start, end) in enumerate(segments(other, k)):
            low = max(start - i, start + gap - (k - i), 0)
            high = min(start + i, start + gap + (k - i), length - (end - start))
            out += [(other * 8 + i, p, p + end - start) for p in range(low, high + 1)]
    return out


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance of a and b is at most k.

    Row d of the band holds a bit for each diagonal reached with at most d edits; one
    character of b updates all diagonals at once.
    """
    if abs(len(a) - len(b)) > k:
        return False
    n = min(len(a), len(b))
    lead = 0
    step = 1 << max(0, n.bit_length() - 1)
    while step:
        if lead + step <= n and a[lead : lead + step] == b[lead : lead + step]:
            lead += step
        else:
            step >>= 1
    a, b = a[lead:], b[lead:]
    if not a or not b:
        return True
    width = 2 * k + 1
    full = (1 << width) - 1
    rows = [((1 << (d + 1)) - 1) << k & full for d in range(k + 1)]
    padded = "\x00" * k + a + "\x01" * (k + 1)
    for j, c in enumerate(b):
        equal = 0
        for p, x in enumerate(padded[j : j + width]):
            equal |= (x == c and 0 <= j + p - k < len(a)) << p
        new = [rows[0] & equal]
        for d in range(1, k + 1):
            new.append(((rows[d] & equal) | rows[d - 1] | (rows[d - 1] >> 1) | (new[d - 1] << 1)) & full)
        rows = new
        if not rows[k]:
            return False
    return bool(rows[k] >> (len(a) - len(b) + k) & 1)


def _hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2")]


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, version, line_no, line, h1, h2) of all lines but short ones without a letter or digit."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    lines = rows.where("text is not null").select("doc_id", "version", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    counts = (F.length("line") >= MIN_CHARS) | F.col("line").rlike(r"[\p{L}\p{N}]")
    return lines.where(counts).select("doc_id", "version", "line_no", "line", *_hashes(F.col("line")))


class _Keys:
    """64-bit keys of the segments and probes of whole batches of lines.

    A key is the polynomial hash of a substring's code points, taken from prefix sums,
    mixed with the seed of its plan. Substrings planned for lines above _LONG characters
    are hashed one by one, so that no long line needs arrays of its own length.
    """

    def __init__(self):
        self.plans: dict[int, np.ndarray] = {}
        self.power = self.inverse = np.ones(1, np.uint64)

    def _plan(self, length: int) -> np.ndarray:
        """Rows (seed, role, start, end): what a line of this length publishes (0) and asks for (1)."""
        if length not in self.plans:
            own = [(length * 8 + i, 0, s, e) for i, (s, e) in enumerate(segments(length, allowed(length)))]
            self.plans[length] = np.array(own + [(seed, 1, s, e) for seed, s, e in probes(length)], np.int64)
        return self.plans[length]

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            self.power, self.inverse = (
                np.cumprod(np.array([1] + [base] * (2 * n - 1), np.uint64)) for base in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return self.power[:n], self.inverse[:n]

    def of(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the line, key with the role as its lowest bit) of every segment and probe."""
        lengths = np.array([len(x) for x in lines], np.int64)
        kinds, kind = np.unique(lengths, return_inverse=True)
        plans = [self._plan(n) for n in kinds.tolist()]
        sizes = np.array([len(p) for p in plans])
        count = sizes[kind]
        owner = np.repeat(np.arange(len(lines)), count)
        first = np.cumsum(sizes) - sizes
        seed, role, start, end = np.concatenate(plans)[np.arange(len(owner)) + np.repeat(first[kind] - (np.cumsum(count) - count), count)].T
        seed, role = seed.astype(np.uint64), role.astype(np.uint64)
        long = seed >> np.uint64(3) > np.uint64(_LONG)
        value = np.zeros(len(owner), np.uint64)
        plain = np.flatnonzero(~long)
        short = [x if n <= _LONG + MAX_EDITS else "" for x, n in zip(lines, lengths.tolist(), strict=True)]
        codes = np.frombuffer("".join(short).encode("utf-32-le"), np.uint32)
        power, inverse = self._powers(len(codes) + 1)
        prefix = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_mixed(codes.astype(np.uint64)) * power[: len(codes)], out=prefix[1:])
        kept = np.array([len(x) for x in short], np.int64)
        place = (np.cumsum(kept) - kept)[owner[plain]]
        low = place + start[plain]
        value[plain] = (prefix[place + end[plain]] - prefix[low]) * inverse[low]
        for k in np.flatnonzero(long).tolist():
            value[k] = xxhash.xxh3_64_intdigest(lines[owner[k]][start[k] : end[k]])
        return owner, (_mixed(value + seed * np.uint64(_BASE)) & np.uint64(0xFFFFFFFFFFFFFFFE)) | role


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_SPREAD)
    return x ^ (x >> np.uint64(29))


def _published(lines: DataFrame, parts: int) -> DataFrame:
    """(part, entries): keys of segments and probes with the line's hash, packed by part of the key space."""

    def run(batches):
        hashed = _Keys()
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        owners: list[np.ndarray] = []

        def packed():
            key, line = np.concatenate(keys), np.concatenate(owners)
            keys.clear(), owners.clear()
            part = ((key >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            entry = np.empty(len(key), _ENTRY)
            entry["key"], entry["line"] = key[order], line[order]
            part = part[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            first = np.concatenate([[0], cuts])
            blobs = [entry[a:b].tobytes() for a, b in zip(first.tolist(), [*cuts.tolist(), len(entry)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(part[first], pa.int32()), pa.array(blobs, pa.binary())], ["part", "entries"])

        for batch in slices(batches, 2048):
            fresh = [(x, h) for x, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if not (h in seen or seen.add(h))]
            if not fresh:
                continue
            owner, key = hashed.of([x for x, _ in fresh])
            keys.append(key)
            owners.append(np.array([h for _, h in fresh], np.int64)[owner])
            if sum(map(len, keys)) > 1_000_000:
                yield packed()
            if len(seen) > 500_000:
                seen.clear()
        if keys:
            yield packed()

    return lines.select("line", "h1").mapInArrow(run, "part int, entries binary")


def _meetings(published: DataFrame) -> DataFrame:
    """(key, line): the lines at keys that one line publishes and another one asks for."""

    def run(batches):
        blobs = [b for batch in batches for b in batch.column(1).to_pylist()]
        if not blobs:
            return
        entry = np.frombuffer(b"".join(blobs), _ENTRY)
        del blobs
        order = np.argsort(entry["key"])
        key, line = entry["key"][order], entry["line"][order]
        del entry, order
        role = (key & np.uint64(1)).astype(bool)
        key = key >> np.uint64(1)
        begin = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(begin)
        differ = np.maximum.reduceat(line, starts) != np.minimum.reduceat(line, starts)
        both = np.logical_or.reduceat(role, starts) & np.logical_or.reduceat(~role, starts)
        keep = np.repeat(differ & both, np.diff(np.append(starts, len(key))))
        key, line = key[keep].astype(np.int64), line[keep]
        order = np.lexsort((line, key))
        key, line = key[order], line[order]
        once = np.ones(len(key), bool)
        once[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
        key, line = key[once], line[once]
        for at in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[at : at + 100_000]), pa.array(line[at : at + 100_000])], ["key", "line"])

    return published.mapInArrow(run, "key bigint, line bigint")


def _verified(block: pa.Table) -> pa.Table:
    """Links that join the lines of a block, as few as do so."""
    lines, ids = block["text"].to_pylist(), block["id"].to_pylist()
    chunk = np.asarray(block["chunk"].combine_chunks())
    i, j = block["i"][0].as_py(), block["j"][0].as_py()
    length = np.array([len(x) for x in lines])
    bags = np.zeros((len(lines), 64), np.int32)
    for k, line in enumerate(lines):
        codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
        bags[k] = np.bincount(codes & 63, minlength=64)
    root = list(range(len(lines)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links: list[tuple] = []
    left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    for x in left.tolist():
        others = right[right > x] if i == j else right
        k = np.minimum(MAX_EDITS, np.minimum(length[others], length[x]) // MIN_CHARS)
        near = others[(np.abs(length[others] - length[x]) <= k) & (np.abs(bags[others] - bags[x]).sum(axis=1) <= 2 * k)]
        for y in near.tolist():
            a, b = top(x), top(y)
            if a != b and ids[x] != ids[y] and within(lines[x], lines[y], allowed(min(length[x], length[y]))):
                root[max(a, b)] = min(a, b)
                links.append((ids[x], ids[y]))
    return pa.table({c: pa.array([p[k] for p in links], pa.binary()) for k, c in enumerate("ab")})


def line_links(lines: DataFrame) -> DataFrame:
    """(a, b): links between different lines (16-byte ids), enough to span every class."""
    total = max(1, lines.count())
    parts = max(1, -(-total * 260 // _PART_BYTES))
    published = _published(lines, parts).repartition(parts, "part")
    met = saved(_meetings(published), "line-meetings")
    sizes = saved(met.groupBy("key").agg(F.count("*").alias("size")), "line-keys")
    wanted = met.select(F.col("line").alias("h1")).distinct()
    likely = _likely(lines.select("h1", "h2", "line"), wanted)
    # An inner join with distinct hashes: a semi-join would be moved below the map.
    texts = likely.join(wanted, "h1").dropDuplicates(["h1", "h2"])
    texts = saved(texts.select(F.col("h1").alias("line"), _line_id().alias("id"), F.col("line").alias("text")), "line-texts")
    parts_of = F.ceil(F.col("size") / BLOCK).cast("int")
    cut = met.join(sizes, "key").withColumn("chunk", F.pmod(F.xxhash64("line"), parts_of).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), parts_of - 1)))
    cut = cut.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "line")
    return cut.join(texts, "line").groupBy("key", "i", "j").applyInArrow(_verified, "a binary, b binary")


def _likely(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """The lines whose bit is set in a map of 2^25 bits of the wanted hashes, before they are shuffled.

    The map is broadcast: at most _MAP_WORDS rows, whatever the number of hashes. A full
    map lets all lines through; the join that follows is exact either way.
    """
    word = lambda h: F.pmod(F.shiftright(h, 6), F.lit(_MAP_WORDS))
    bit = lambda h: F.expr(f"shiftleft(1L, cast({h} & 63 as int))")
    words = wanted.groupBy(word("h1").alias("word")).agg(F.bit_or(bit("h1")).alias("bits"))
    hits = lines.withColumn("word", word("h1")).join(F.broadcast(saved(words, "line-map")), "word")
    return hits.where(F.col("bits").bitwiseAND(bit("h1")) != 0).select("h1", "h2", "line")


def _line_id() -> Column:
    return F.unhex(F.concat(F.lpad(F.hex("h1"), 16, "0"), F.lpad(F.hex("h2"), 16, "0")))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, version, removed): line numbers, from 0, that repeat an earlier line.

    docs: (doc_id, text). Lines end with a newline. Those below MIN_CHARS characters
    repeat only equal ones, and never if they hold no letter or digit (blank lines,
    rules, brackets). Earlier is the order of doc_id (rows without one last),
    then of line numbers. `version` is the hash of the text: rows repeated in full
    share their decisions, so the first occurrence stays in each of them. Documents
    without repeated lines, null and empty texts are not listed.
    """
    lines = _lines(docs)
    places = saved(lines.select("doc_id", "version", "line_no", "h1", "h2"), "line-places")
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.col("version"), F.col("line_no"))
    firsts = saved(places.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(order).alias("first")), "line-firsts")
    firsts = firsts.withColumn("id", _line_id())
    comps = components(saved(line_links(lines.where(F.length("line") >= MIN_CHARS)), "line-links"))
    classed = firsts.join(comps, "id", "left").select("h1", "h2", "n", "first", F.coalesce("component", "id").alias("comp"))
    classes = saved(
        classed.groupBy("comp").agg(F.sum("n").alias("n"), F.min("first").alias("first")).where("n > 1"), "line-classes"
    )
    rule = saved(classed.select("h1", "h2", "comp").join(classes.select("comp", "first"), "comp").select("h1", "h2", "first"), "line-rule")
    repeats = places.join(rule, ["h1", "h2"]).where(order != F.col("first"))
    return repeats.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed): a row for each row of docs (doc_id, text).

    A null text has no lines, an empty one has one. See removed_lines.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("version"),
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias("n_lines"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0)).cast("long"))
    gone = removed_lines(docs).withColumnRenamed("doc_id", "__doc").withColumnRenamed("version", "__version")
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("version") == F.col("__version")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """docs, all columns, with repeated lines taken out of `text`.

    A document that loses lines and keeps no letter or digit goes; all other rows stay,
    also those with null or empty text. `n_chars`, where there is one, is brought up
    to date in the documents that change.
    """
    gone = removed_lines(docs).select(F.col("doc_id").alias("id"), "version", "removed")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc"),
        F.col("text").cast("string").alias("whole"),
    )
    same = F.col("doc").eqNullSafe(F.col("id")) & (F.xxhash64("whole") == F.col("version"))
    changed = F.col("removed").isNotNull()
    left = F.array_join(F.filter(F.split("whole", "\n"), lambda _, i: ~F.array_contains(F.col("removed"), i)), "\n")
    joined = rows.join(gone, same, "left").withColumn("left", F.when(changed, left).otherwise(F.col("whole")))
    joined = joined.where(~changed | F.col("left").rlike(r"[\p{L}\p{N}]"))
    new = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("left").cast(kind)).otherwise(F.col("row.n_chars"))
    return joined.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
