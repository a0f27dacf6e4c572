"""Candidate pairs of many groups at once, and how often blocks copy the rows of a key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from test_order_minhash import expected, families

from opinara.llm import linking
from opinara.llm.linking import Rules, equal
from opinara.llm.order_minhash import near_duplicates

WIDTH = 8


def agreement(x, y, matrix):
    return (x[:, None] == y[None, :]).sum(axis=2) if matrix else equal(x, y)


RULES = Rules(lambda c: np.frombuffer(b"".join(c), np.uint16).reshape(-1, WIDTH), agreement, lambda n, m: 4, lambda a, b: True, 0.8, 0)


def groups(rng):
    """Rows of groups of the three kinds: one chunk, two chunks, the largest component against others."""
    out = []
    for g in range(60):
        size = 150 if g % 20 == 0 else int(rng.integers(1, 12))
        kind = g % 3
        for r in range(size):
            part = r % 2
            out.append(
                {
                    "key": int(rng.integers(0, 2)) if g == 0 else g, "within": kind < 2, "i": 0, "j": int(kind == 1), "chunk": part if kind else 0,
                    "side": part if kind == 2 else 1, "id": b"%d-%d" % (g, r), "comp": b"c%d" % rng.integers(0, 6), "n": int(rng.integers(8, 12)),
                    "keys": [int(k) for k in rng.integers(0, 3, 2)] + [g], "sample": rng.integers(0, 3, WIDTH).astype(np.uint16).tobytes(),
                }
            )
    return sorted(out, key=lambda r: (r["key"], r["within"], r["i"], r["j"]))


def slowly(rows):
    found = set()
    for p, a in enumerate(rows):
        for q, b in enumerate(rows):
            if any(a[c] != b[c] for c in ("key", "within", "i", "j")) or a["comp"] == b["comp"]:
                continue
            if a["within"]:
                meet = p < q if a["i"] == a["j"] else (a["chunk"], b["chunk"]) == (a["i"], a["j"])
            else:
                meet = (a["side"], b["side"]) == (0, 1)
            same = int(equal(*[RULES.samples([r["sample"]]) for r in (a, b)])[0])
            first = next((x for x, y in zip(a["keys"], b["keys"], strict=True) if x == y), a["keys"][0])
            if meet and same >= 4 and min(a["n"], b["n"]) >= 0.8 * max(a["n"], b["n"]) and first == a["key"]:
                found.add((frozenset((a["id"], b["id"])), same))
    return found


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("lot", [7, 8192])
def test_candidates_of_many_groups(monkeypatch, seed, lot):
    monkeypatch.setattr(linking, "_PAIRS", 1000)
    rows = groups(np.random.default_rng(seed))
    table = pa.Table.from_pylist(rows)
    found, read = set(), 0
    for block in linking._whole_groups(table.to_batches(max_chunksize=5), lot):
        x, y, same, comp = linking._candidates(block, RULES)
        ids = block["id"].to_pylist()
        found |= {(frozenset((ids[p], ids[q])), s) for p, q, s in zip(x.tolist(), y.tolist(), same.tolist(), strict=True)}
        read += block.num_rows
    assert read == len(rows)
    assert found == slowly(rows) != set()


def test_copies_stay_linear_in_keys_of_many_chunks(spark, monkeypatch):
    """Members of a key that are all apart go to one block of it, not to one for each chunk."""
    monkeypatch.setattr(linking, "BLOCK", 4)
    made = []
    candidates = linking._local_blocks
    monkeypatch.setattr(linking, "_local_blocks", lambda *given: made.append(candidates(*given).count()) or candidates(*given))
    monkeypatch.setattr(linking, "_all_blocks", lambda placed, *_: made.append("all"))
    got = near_duplicates(spark.createDataFrame(apart(), "doc_id long, text string")).collect()
    assert len(got) == 60 and all(r.doc_id == r.class_id for r in got)
    assert len(made) == 2 and 0 < made[1] <= made[0]


def apart():
    shared = " ".join(f"s{k}" for k in range(40))
    return [(d, shared + " " + " ".join(f"w{d}-{k}x" for k in range(20))) for d in range(60)]


def test_keys_of_one_chunk_meet_once(spark, monkeypatch):
    """Later steps read keys of several chunks only: in all others any two members have met."""
    seen = []
    blocks = linking._local_blocks
    monkeypatch.setattr(linking, "_local_blocks", lambda *given: seen.append(1) or blocks(*given))
    monkeypatch.setattr(linking, "_all_blocks", lambda *given: seen.append(2))
    got = near_duplicates(spark.createDataFrame(apart(), "doc_id long, text string")).collect()
    assert all(r.doc_id == r.class_id for r in got)
    assert seen == [1]


def test_blocks_of_large_keys(spark, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK", 4)
    monkeypatch.setattr(linking, "LARGEST", 8)
    rows = families()
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected(rows)
