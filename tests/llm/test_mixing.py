"""Temperature mixing against a plain computation over all rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pytest

from opinara.llm.mixing import entropy, exponent_for, mixture, quotas, weights_at

SF = "/root/testdata/sf0.01"


def expected(rows, share, repeats, budget=None, seed="mix"):
    """Counter of (doc_id, source, copy) by walking each pass row by row."""
    count = lambda t: len(re.findall(r"[^ \t\n\x0b\f\r]+", t or ""))
    by: dict = {}
    for doc, source, text in rows:
        key = f"{'' if doc is None else doc}|{hashlib.md5((text or '').encode()).hexdigest()}"
        by.setdefault("null" if source is None else "s" + source, []).append((doc, source, count(text), key))
    names = sorted(n for n, v in by.items() if sum(r[2] for r in v))
    tokens = [sum(r[2] for r in by[n]) for n in names]
    budget = sum(tokens) if budget is None else budget
    out = Counter()
    for name, total, quota in zip(names, tokens, quotas(tokens, budget, exponent_for(tokens, budget, share, repeats)), strict=True):
        left, copy = quota, 0
        while left > 0:
            place = lambda r: int(hashlib.md5(f"{seed}|{copy}|{r[3]}".encode()).hexdigest()[:12], 16)  # noqa: B023, E731
            if left >= total:
                out.update((r[0], r[1], copy) for r in by[name])
                left -= total
            else:
                groups: dict = {}
                for r in by[name]:
                    groups.setdefault(place(r), []).append(r)
                for _, group in sorted(groups.items()):
                    left -= sum(r[2] for r in group)
                    if left < 0:
                        break
                    out.update((r[0], r[1], copy) for r in group)
                break
            copy += 1
    return out


@pytest.mark.parametrize(("share", "repeats", "budget"), [(0.97, 4.0, None), (None, 1.5, None), (0.99, None, 300_000), (None, None, 5000), (0.5, 2.0, None)])
def test_whole_table(spark, share, repeats, budget):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = mixture(docs, share, repeats, budget).collect()
    assert Counter((r.doc_id, r.source, r.copy) for r in got) == expected(rows, share, repeats, budget)
    assert all(0 <= r.position < 1 for r in got)


def test_weights_hold_in_every_stretch(spark):
    docs = spark.createDataFrame([(k, "ab"[k % 3 == 0], "one two three") for k in range(6000)], "doc_id long, source string, text string")
    got = sorted(mixture(docs, None, None).collect(), key=lambda r: r.position)
    for at in range(0, 6000, 1000):
        part = Counter(r.source for r in got[at : at + 1000])
        assert abs(part["a"] - 500) < 60


def test_exponent():
    tokens = [900, 90, 10]
    t = exponent_for(tokens, 1000, 0.6, None)
    assert math.isclose(entropy(weights_at(tokens, t)), 0.6 * math.log(3), rel_tol=1e-9)
    t = exponent_for(tokens, 1000, None, 5)
    assert math.isclose(weights_at(tokens, t)[2] * 1000, 50, rel_tol=1e-6)
    assert exponent_for(tokens, 1000, None, None) == 0 and sum(quotas(tokens, 1001, 0.3)) == 1001
    assert exponent_for([5], 10, 0.5, 1.0) in (0.0, 1.0)


def test_edge_cases(spark):
    rows = [(1, "a", "x y"), (1, "a", "x y"), (2, "a", None), (3, None, "z"), (None, None, "z"), (4, "b", ""), (5, "c", "w " * 100_000)]
    df = spark.createDataFrame([(*r, 9, "q") for r in rows], "doc_id long, source string, text string, copy int, rest string")
    got = mixture(df, None, None)
    assert got.columns == ["doc_id", "source", "text", "rest", "copy", "position"]
    assert Counter((r.doc_id, r.source, r.copy) for r in got.collect()) == expected(rows, None, None)
    assert mixture(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="sources"):
        mixture(df, max_sources=1)


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(k, "a b c", f"s{k % 2}", k, "x") for k in range(40)], "doc_id long, text string, source string, __key int, __source string")
    got = mixture(df)
    assert got.columns == [*df.columns, "copy", "position"]
    assert all(r["__key"] == r.doc_id and r["__source"] == "x" for r in got.collect())
