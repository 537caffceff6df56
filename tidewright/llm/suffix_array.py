"""Suffix order by the difference-cover algorithm, on arrays."""

from __future__ import annotations

import numpy as np


def _names(*columns: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks (equal rows, equal rank) of rows of non-negative columns, and how many there are."""
    key = columns[0].astype(np.int64)
    top = int(key.max()) + 1 if len(key) else 1
    for c in columns[1:]:
        width = int(c.max()) + 1 if len(c) else 1
        if top > (1 << 62) // width:
            kinds, key = np.unique(key, return_inverse=True)
            top = len(kinds)
        key = key * width + c
        top *= width
    kinds, ranks = np.unique(key, return_inverse=True)
    return ranks.astype(np.int64), len(kinds)


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Positions of s (positive integers) in the order of the suffixes that start there.

    The triples at positions not divisible by three are sorted and named; if names
    repeat, the string of names is ordered in the same way. The other suffixes
    are sorted by their first value and the rank of what follows, and merged in.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    one, two, nil = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([one, two])  # one more after the end if the last suffix starts at 0 modulo 3
    name, kinds = _names(t[sample], t[sample + 1], t[sample + 2])
    if kinds < len(sample):
        order = suffix_order(name + 1)
        name = np.empty(len(sample), np.int64)
        name[order] = np.arange(len(sample))
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = name + 1
    by_name = np.argsort(name, kind="stable")
    sorted12 = sample[by_name]
    sorted12 = sorted12[sorted12 < n]
    width = len(sample) + 2
    key0 = t[nil] * width + rank[nil + 1]
    order0 = np.argsort(key0, kind="stable")
    sorted0 = nil[order0]
    is_one = sorted12 % 3 == 1
    ones, twos = sorted12[is_one], sorted12[~is_one]
    less = np.searchsorted(t[ones] * width + rank[ones + 1], key0[order0])
    both = np.concatenate([sorted0, twos])
    pair, _ = _names(t[both], t[both + 1])
    key2 = pair * width + rank[both + 2]
    less += np.searchsorted(key2[len(sorted0) :], key2[: len(sorted0)])
    out = np.empty(n, np.int64)
    at = less + np.arange(len(sorted0))
    out[at] = sorted0
    free = np.ones(n, bool)
    free[at] = False
    out[free] = sorted12
    return out


def equal_runs(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Run number of each of starts (in suffix order): neighbours whose next `length` bytes are equal share one."""
    if not len(starts):
        return np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for b in range(8):
        words |= padded[b : b + len(data)] << np.uint64(8 * b)
    same = np.ones(len(starts) - 1, bool)
    for offset in sorted({*range(0, length - 7, 8), max(0, length - 8)}):
        w = words[starts + offset]
        same &= w[1:] == w[:-1]
    return np.concatenate([[0], np.cumsum(~same)])
