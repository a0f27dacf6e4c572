"""The segment-partition edit join against all pairs of lines."""

from __future__ import annotations

import random

import pytest
from brute import classes, edit_distance

from opinara.llm.line_dedup import _LONG, MAX_EDITS, _Keys, allowed, line_report, probes, segments, within, without_repeated_lines


def expected(rows):
    places, order = {}, []
    for doc, text in rows:
        for no, line in enumerate(text.split("\n") if text is not None else []):
            if len(line) >= 20 or any(c.isalnum() for c in line):
                places.setdefault(line, []).append((doc, no))
                order.append((doc, no, line))
    lines = sorted(places)
    long = [line for line in lines if len(line) >= 20]
    links = [
        (a, b) for a in long for b in long
        if a < b and abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= allowed(min(len(a), len(b)))
    ]
    top = classes(lines, links)
    first = {}
    for line, where in places.items():
        first[top[line]] = min([first.get(top[line], min(where)), *where])
    gone = {}
    for doc, no, line in order:
        if (doc, no) != first[top[line]]:
            gone.setdefault(doc, []).append(no)
    return gone


def noisy(rng, line, edits):
    line = list(line)
    for _ in range(edits):
        p = rng.randrange(len(line) + 1)
        line[p : p + rng.choice((0, 1))] = rng.choice(("", "x", "é", "q"))
    return "".join(line)


@pytest.mark.parametrize("seed", range(3))
def test_within_is_the_edit_distance(seed):
    rng = random.Random(seed)
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 25)))
        b = noisy(rng, a, rng.randrange(4))
        for k in range(4):
            assert within(a, b, k) == (edit_distance(a, b) <= k), (a, b, k)


def test_every_close_pair_meets():
    rng = random.Random(5)
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(20, 60)))
        b = noisy(rng, a, rng.randrange(3))
        a, b = sorted((a, b), key=len)
        if len(a) < 20 or edit_distance(a, b) > allowed(len(a)):
            continue
        own = {(len(a) * 8 + i, a[s:e]) for i, (s, e) in enumerate(segments(len(a), allowed(len(a))))}
        assert own & {(seed, b[s:e]) for seed, s, e in probes(len(b))}
    assert MAX_EDITS == 2


def test_equal_substrings_and_only_these_have_equal_keys():
    rng = random.Random(1)
    lines = ["".join(rng.choice("abé") for _ in range(rng.randrange(20, 70))) for _ in range(800)]
    lines += ["é" * n for n in (20, 21, 9000, *range(_LONG - 2, _LONG + 5))]
    hashed = _Keys()
    owner, keys = hashed.of(lines)
    at, of_key, of_text = 0, {}, {}
    for k, line in enumerate(lines):
        n = len(line)
        plan = [(n * 8 + i, 0, s, e) for i, (s, e) in enumerate(segments(n, allowed(n)))] + [(seed, 1, s, e) for seed, s, e in probes(n)]
        for (seed, role, s, e), own, key in zip(plan, owner[at:].tolist(), keys[at:].tolist(), strict=False):
            text = (seed, line[s:e])
            assert own == k and key & 1 == role
            assert of_text.setdefault(text, key >> 1) == key >> 1 and of_key.setdefault(key >> 1, text) == text
        at += len(plan)
    assert at == len(keys)


def test_documents_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr("opinara.llm.line_dedup.BLOCK", 8)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(18, 70))) for _ in range(25)]
    stem = "a common beginning of many lines " + "".join(rng.choice("abc") for _ in range(20))
    rows = []
    for doc in range(60):
        lines = [noisy(rng, rng.choice(base), rng.choice((0, 0, 1, 2, 4))) for _ in range(rng.randrange(1, 6))]
        lines.append(stem[:-6] + "".join(rng.choice("xyz") for _ in range(6)))
        rows.append((doc, "\n".join(lines)))
    got = {r.doc_id: r.removed for r in line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.removed}
    assert got == expected(rows)


LONG = "this line is long enough to count"
EDGE = [
    (1, f"{LONG}\nshort\n{LONG}", 7), (2, f"short\n{LONG}!", 7), (3, LONG, 7), (4, None, 7), (5, "", 7), (6, "short", 7),
    (7, "unique and long enough to stay here", 7), (8, "y" * 200_000, 7), (9, "y" * 200_001 + "\nrest", 7), (None, f"{LONG}\nkept", 7), (3, LONG, 7),
]


def test_edge_cases(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, n_chars long").withColumnRenamed("n_chars", "n_chars")
    got = sorted(((r.doc_id, r.n_lines, r.removed) for r in line_report(df).collect()), key=str)
    want = [(1, 3, [2]), (2, 2, [0, 1]), (3, 1, [0]), (4, 0, []), (5, 1, []), (6, 1, [0]), (7, 1, []), (8, 1, []), (9, 2, [0]), (None, 2, [0]), (3, 1, [0])]
    assert got == sorted(want, key=str)
    left = {r.doc_id: (r.text, r.n_chars) for r in without_repeated_lines(df).collect()}
    assert left == {
        1: (f"{LONG}\nshort", 39), 4: (None, 7), 5: ("", 7), 7: (EDGE[6][1], 7), 8: ("y" * 200_000, 7),
        9: ("rest", 4), None: ("kept", 4),
    }
    assert line_report(df.limit(0)).count() == 0 and without_repeated_lines(df.limit(0)).count() == 0


def test_short_lines_repeat_only_equal_ones(spark):
    rows = [(1, "Read more\n\n---\n}\n7"), (2, "Read more\nRead mores\n---\n\n}"), (3, "7\nread more\nRead more\né"), (4, "é\n \n---")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.removed for r in line_report(df).collect()}
    assert got == {1: [], 2: [0], 3: [0, 2], 4: [0]}
    left = {r.doc_id: r.text for r in without_repeated_lines(df).collect()}
    assert left == {1: rows[0][1], 2: "Read mores\n---\n\n}", 3: "read more\né"}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, LONG, "a", 2), (2, LONG, "b", 3)], "doc_id long, text string, line string, removed int")
    assert line_report(df).count() == 2 and without_repeated_lines(df).columns == df.columns


def test_a_column_named_key_stays(spark):
    line = "one line of text that repeats itself in two documents"
    df = spark.createDataFrame([(1, line, "k1", 5), (2, f"{line}\nrest", "k2", 6)], "doc_id long, text string, __key string, removed int")
    got = without_repeated_lines(df).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, line, "k1", 5), (2, "rest", "k2", 6)]
