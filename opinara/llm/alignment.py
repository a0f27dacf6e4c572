"""Banded bit-parallel alignments of sequences."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def banded_lcs(a: Sequence, b: Sequence, max_indels: int) -> int:
    """Length of the longest common subsequence of alignments within the band.

    Exact if a and b differ by at most max_indels insertions and deletions, else
    a lower bound. One machine-word row of the band (a Python integer) per element
    of b.
    """
    lead = 0
    while lead < len(a) and lead < len(b) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < len(a) - lead and tail < len(b) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[lead : len(a) - tail], b[lead : len(b) - tail]
    delta = len(a) - len(b)
    if abs(delta) > max_indels:
        return lead + tail
    below, above = (max_indels - delta) // 2, (max_indels + delta) // 2
    width = below + above + 1
    full = (1 << width) - 1
    places: dict = {}
    for p, x in enumerate(a):
        places.setdefault(x, []).append(p)
    same = 0
    row = full  # bit p: column low + p adds no match
    low = -below
    for x in b:
        hits = 0
        for p in places.get(x, ()):
            if 0 <= p - low < width:
                hits |= 1 << (p - low)
        if hits:
            u = row & hits
            row = ((row + u) | (row - u)) & full
        same += 1 - (row & 1)
        row = (row >> 1) | (1 << (width - 1))
        low += 1
    same += width - bin(row).count("1")
    return lead + tail + same


def sequence_similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """LCS / (len(a) + len(b) - LCS) where it reaches `least`, else 0.

    Two cheap upper bounds (lengths, then common elements) come before the alignment.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    if int(np.minimum(ca[ia], cb[ib]).sum()) < need:
        return 0.0
    same = banded_lcs(a.tolist(), b.tolist(), n + m - 2 * need)
    return same / (n + m - same) if same >= need else 0.0
