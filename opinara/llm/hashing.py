"""Hashes of words, word shingles and word sequences, vectorised over many texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from opinara.llm.common import WORD_BYTES

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 19
_COEFFICIENTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_powers: dict[int, np.ndarray] = {}

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 16), base, U)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=U)
    return _powers[base][:n]


def _pieces(text: bytes) -> Iterator[bytes]:
    """A blank-separated text cut at blanks, so that a piece holds about _PIECE bytes."""
    at = 0
    while len(text) - at > _PIECE:
        cut = text.rfind(b" ", at, at + _PIECE)
        if cut < 0:
            cut = text.find(b" ", at)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def _hash_words(text: bytes, lead: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a blank-separated text, or of its first `lead` bytes."""
    data = np.frombuffer(b" " + text + b" ", np.uint8)
    inside = data != 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    if lead:
        ends = np.minimum(ends, starts + lead)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(_BASE, len(data)), out=sums[1:])
    return starts - 1, mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(data))[starts])


def hashed_words(texts: list[bytes], lead: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, number of words of each text).

    With `lead`, words count as far as their first so many bytes.
    """
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    group: list[bytes] = []
    first, size = 0, 0

    def flush(end: int) -> None:
        nonlocal group, first, size
        if group:
            starts, found = _hash_words(b" ".join(group), lead)
            edges = np.cumsum([0] + [len(t) + 1 for t in group])
            counts[first:end] = np.diff(np.searchsorted(starts, edges))
            hashes.append(found)
        group, first, size = [], end, 0

    for k, raw in enumerate(texts):
        text = raw.translate(WORD_BYTES)
        if len(text) > _PIECE:
            flush(k)
            for piece in _pieces(text):
                found = _hash_words(piece, lead)[1]
                hashes.append(found)
                counts[k] += len(found)
            first = k + 1
        else:
            group.append(text)
            size += len(text) + 1
            if size > _PIECE:
                flush(k + 1)
    flush(len(texts))
    return (np.concatenate(hashes) if hashes else np.zeros(0, U)), counts


def positions(counts: np.ndarray) -> np.ndarray:
    """Position of every element within its text."""
    starts = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - np.repeat(starts, counts)


def sums_by_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum (modulo 2^64) of each text's values; 0 for a text without values."""
    total = np.concatenate([np.zeros(1, U), np.cumsum(values, dtype=U)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def sequence_digests(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(texts, 2) 64-bit hashes of each text's word sequence."""
    at = positions(counts)
    n = int(counts.max(initial=0))
    out = [mix(sums_by_text(words * powers(base, n)[at], counts) + counts.astype(U)) for base in (_BASE, 0xC2B2AE3D27D4EB4F)]
    return np.stack(out, axis=1)


def shingles(words: np.ndarray, counts: np.ndarray, digests: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of `size` words, number of runs by text).

    A text of fewer words, but not none, has one run: all its words.
    """
    per_text = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    total = len(words)
    if not total:
        return np.zeros(0, U), per_text
    padded = np.concatenate([words, np.zeros(size - 1, U)])
    runs = np.zeros(total, U)
    for k in range(size):
        runs += padded[k : k + total] * _COEFFICIENTS[k % 5] * U(2 * (k // 5) + 1)
    runs = mix(runs)
    starts = np.cumsum(counts) - counts
    short = (counts > 0) & (counts < size)
    runs[starts[short]] = digests[short, 0]
    return runs[positions(counts) < np.repeat(per_text, counts)], per_text


def labelled(runs: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Runs told apart by their occurrence number within the text."""
    text = np.repeat(np.arange(len(per_text), dtype=U), per_text)
    key = mix(runs ^ mix(text + U(1)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    begins = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
    rank = np.arange(len(ordered)) - np.maximum.accumulate(np.where(begins, np.arange(len(ordered)), 0))
    number = np.empty(len(ordered), np.int64)
    number[order] = rank
    return mix(runs + number.astype(U) * U(0xD1B54A32D192ED03))
