"""A straight-line grammar of many token sequences at once, by Re-Pair, in numpy.

Every round gives each adjacent pair of symbols its number of occurrences and replaces a
repeated pair wherever no more frequent pair overlaps it. When no pair repeats, what is
left of each sequence is folded in neighbouring twos up to one symbol. So each rule has
two parts, and all positions at which a rule is derived are those where it was put in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Rules:
    """The rules of one round and every place where they are derived.

    Rule k covers `left[k] + right[k]` tokens; `first[k]` is one of its places. Place i
    is derived from rule `rule[i]` at token `at[i]`; places are in order of their rule.
    """

    left: np.ndarray
    right: np.ndarray
    first: np.ndarray
    rule: np.ndarray
    at: np.ndarray


def _repeated(symbols: np.ndarray, open_: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank by frequency of the pair at each position or 0, number of its pair) for repeated pairs."""
    rank = np.zeros(len(symbols), np.int64)
    number = np.zeros(len(symbols), np.int64)
    at = np.flatnonzero(open_)
    if len(at):
        _, pair, count = np.unique(symbols[at] * top + symbols[at + 1], return_inverse=True, return_counts=True)
        place = np.empty(len(count), np.int64)
        place[np.argsort(count, kind="stable")] = np.arange(1, len(count) + 1)
        rank[at] = np.where(count[pair] > 1, place[pair], 0)
        number[at] = pair
    return rank, number


def _chosen(rank: np.ndarray) -> np.ndarray:
    """Positions whose pair no more frequent pair overlaps; every other one in a row of equal pairs."""
    padded = np.concatenate([[0], rank, [0]])
    best = (rank > 0) & (rank >= padded[:-2]) & (rank >= padded[2:])
    at = np.arange(len(rank))
    opens = best & ~np.concatenate([[False], best[:-1]])
    return best & ((at - np.maximum.accumulate(np.where(opens, at, 0))) % 2 == 0)


def rounds(tokens: np.ndarray, sizes: np.ndarray) -> Iterator[Rules]:
    """Rules for the sequences of `sizes` tokens that stand one after the other in `tokens`."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    symbols = tokens.astype(np.int64)
    top = int(symbols.max(initial=-1)) + 1
    at = np.arange(len(symbols))
    span = np.ones(len(symbols), np.int64)
    # A pair may repeat only where the pairs it came from did: open_ marks these.
    open_ = np.zeros(len(symbols), bool)
    open_[:-1] = owner[:-1] == owner[1:]
    folding = False
    while True:
        if not folding:
            rank, number = _repeated(symbols, open_, top)
            open_ = rank > 0
            take = np.flatnonzero(_chosen(rank))
            folding = not len(take)
        if folding:
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else at
            local = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
            joined = np.zeros(len(owner), bool)
            joined[:-1] = owner[:-1] == owner[1:]
            take = np.flatnonzero(joined & (local % 2 == 0))
            number = np.arange(len(owner))
        if not len(take):
            return
        order = np.argsort(number[take], kind="stable")
        mine = take[order]
        fresh = np.concatenate([[True], number[mine][1:] != number[mine][:-1]])
        rule = np.cumsum(fresh) - 1
        head = mine[fresh]
        yield Rules(span[head], span[head + 1], at[head], rule, at[mine])
        symbols[mine] = top + rule
        top += int(rule[-1]) + 1
        span[mine] += span[mine + 1]
        open_[mine] = open_[mine + 1]
        keep = np.ones(len(symbols), bool)
        keep[take + 1] = False
        symbols, at, span, owner, open_ = symbols[keep], at[keep], span[keep], owner[keep], open_[keep]
