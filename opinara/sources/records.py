"""CSV records from parts of files, also where quoted fields hold line breaks.

A first pass reads every split once and finds, for both possible states at its start
(between records or inside a quoted field), the state at its end. Composed over the splits
of a file this tells where each split's first own record begins, so a file is read by as
many tasks as it has splits. Records that cross a split are put together from their pieces.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPENS = re.compile(r'[,\r\n]"')
_BLOCK = "file string, at bigint, from_out boolean, from_in boolean, header array<string>"
_PIECE = "file string, at bigint, part int, text string"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line that starts inside one or at a record.

    A quote opens a field only as its first character; a doubled quote is a quote.
    """
    if '"' not in line:
        return inside
    at = 0
    if not inside and line[0] == '"':
        inside, at = True, 1
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == '"':
                at += 2
                continue
            inside = False
            at += 1
        opened = _OPENS.search(line, at)
        if not opened:
            return False
        inside, at = True, opened.end()


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, at, line): lines by split; the lines of a split stay together and in order."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(list(paths))
    meta = F.col("_metadata")
    return text.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("at"), F.col("value").alias("line"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, list[str]]]:
    """(file, at, whether the split begins here, lines): runs of lines of one split."""
    last = None
    for batch in batches:
        files, starts, lines = (batch.column(k).to_pylist() for k in range(3))
        begin = 0
        for k in range(1, len(lines) + 1):
            if k == len(lines) or (files[k], starts[k]) != (files[begin], starts[begin]):
                key = files[begin], starts[begin]
                yield *key, key != last, lines[begin:k]
                last, begin = key, k


def parse(lines: Sequence[str]) -> list[list[str]]:
    """Fields of whole records; blank lines are none."""
    csv.field_size_limit(1 << 31)
    broken = (p + "\n" for line in lines for p in (re.split(r"\r(?!$)", line) if "\r" in line and '"' not in line else [line]))
    return [row for row in csv.reader(broken) if row]


def scan_blocks(lines: DataFrame) -> DataFrame:
    """(file, at, from_out, from_in, header): the state at the end of each split for both states at its start.

    `header` holds the fields of the first record, in the first split of a file.
    """

    def scan(batches):
        state: dict[tuple[str, int], list] = {}
        for file, at, fresh, part in _splits(batches):
            key = file, at
            if fresh:
                state[key] = [False, True, None, [] if at == 0 else None]
            out, inner, header, first = state[key]
            for line in part:
                out, inner = ends_inside(line, out), ends_inside(line, inner)
                if first is not None:
                    first.append(line)
                    if not out:
                        rows = parse([first[0].removeprefix("﻿"), *first[1:]])
                        header, first = (rows[0], None) if rows else (None, [])
            state[key] = [out, inner, header, first]
        rows = [(*key, s[0], s[1], s[2]) for key, s in state.items()]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["file", "at", "from_out", "from_in", "header"])

    return lines.mapInArrow(scan, _BLOCK)


def starts_inside(blocks: DataFrame) -> list[tuple[str, int]]:
    """The splits that begin inside a quoted field; there are none in most tables."""

    def walk(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*[table[c].to_pylist() for c in ("file", "at", "from_out", "from_in")], strict=True), key=lambda r: r[1])
        inside, found = False, []
        for file, at, out, inner in rows:
            if inside:
                found.append((file, at))
            inside = inner if inside else out
        files, ats = zip(*found, strict=True) if found else ((), ())
        return pa.table([pa.array(files, pa.string()), pa.array(ats, pa.int64())], names=["file", "at"])

    # A file without an open end needs no walk.
    open_files = blocks.where("from_out").select("file").distinct()
    found = blocks.join(open_files, "file").groupBy("file").applyInArrow(walk, "file string, at bigint")
    return [tuple(r) for r in found.collect()]


def whole_records(lines: DataFrame, inside: set[tuple[str, int]], make: Callable[[str, list[list[str]]], pa.RecordBatch], schema) -> DataFrame:
    """What `make(file, rows of fields)` gives for the records that lie in one split; headers are left out."""

    def read(batches):
        pending: list[str] = []
        skipping = header = False
        for file, at, fresh, part in _splits(batches):
            if fresh:
                pending, skipping, header = [], (file, at) in inside, at == 0
            done = 0
            open_ = bool(pending)
            for k, line in enumerate(part):
                if skipping:
                    skipping = ends_inside(line, True)
                    done = k + 1
                    continue
                open_ = ends_inside(line, open_)
                if not open_:
                    pending += part[done : k + 1]
                    done = k + 1
                    if not header and len(pending) >= 4096:
                        yield make(file, parse(pending))
                        pending = []
                    elif header:
                        rows = parse(pending)
                        if rows:
                            header, pending = False, []
                            if len(rows) > 1:
                                yield make(file, rows[1:])
            # Records that are whole go out; an open one waits for the next lines of its split.
            if done and pending and not header:
                yield make(file, parse(pending))
                pending = []
            pending += part[done:]

    return lines.mapInArrow(read, schema)


def crossing_records(lines: DataFrame, inside: set[tuple[str, int]]) -> DataFrame:
    """(file, at, text): the records that cross splits, each as one text."""
    files = {file for file, _ in inside}

    def pieces(batches):
        # Part 0 continues a record of an earlier split, part 1 opens one that a later split ends.
        held: dict[tuple[str, int], list] = {}
        for file, at, fresh, part in _splits(batches):
            if file not in files:
                continue
            key = file, at
            if fresh:
                held[key] = [[], key in inside, [], key in inside]
            head, in_head, tail, _ = held[key]
            open_ = bool(tail)
            for line in part:
                if in_head:
                    head.append(line)
                    in_head = ends_inside(line, True)
                    continue
                open_ = ends_inside(line, open_)
                tail = [*tail, line] if open_ else []
            held[key] = [head, in_head, tail, held[key][3]]
        rows = [(*key, 0, "\n".join(h)) for key, (h, _, _, began) in held.items() if began]
        rows += [(*key, 1, "\n".join(t)) for key, (_, _, t, _) in held.items() if t]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["file", "at", "part", "text"])

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*[table[c].to_pylist() for c in ("file", "at", "part", "text")], strict=True), key=lambda r: r[1:3])
        out: list[list] = []
        for file, at, part, text in rows:
            if part == 1:
                out.append([file, at, text])
            else:
                out[-1][2] += "\n" + text
        files_, ats, texts = zip(*out, strict=True) if out else ((), (), ())
        return pa.table([pa.array(files_, pa.string()), pa.array(ats, pa.int64()), pa.array(texts, pa.string())], names=["file", "at", "text"])

    return lines.mapInArrow(pieces, _PIECE).groupBy("file").applyInArrow(join, "file string, at bigint, text string")
