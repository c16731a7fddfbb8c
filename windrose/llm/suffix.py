"""Suffix arrays by induced sorting, and permuted common prefixes.

Sequences are integers that end in a unique smallest one.  ``suffix_array``
classifies the suffixes as smaller or larger than their successors, sorts the
substrings between leftmost smaller positions by induction, names them and
recurses on the names where they repeat, then induces the whole array in two
linear passes.
"""

from __future__ import annotations

import numpy as np


def smaller_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (the last one is)."""
    n = len(t)
    out = np.ones(n, bool)
    step = np.sign(np.diff(t))
    # an equal neighbour takes the type of the next unequal pair
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(at[::-1])[::-1]
    decided = np.append(step, 1)
    out[:-1] = decided[following] > 0
    return out


def _induce(t: list[int], small: list[bool], heads: list[int], tails: list[int], sa: list[int]) -> None:
    """Completes ``sa``, which holds leftmost smaller suffixes at their buckets' ends."""
    at = heads.copy()
    for j in sa:
        # later slots are filled while the pass goes on
        if j > 0:
            j -= 1
            if not small[j]:
                c = t[j]
                sa[at[c]] = j
                at[c] += 1
    at = tails.copy()
    for i in range(len(sa) - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and small[j]:
            c = t[j]
            at[c] -= 1
            sa[at[c]] = j


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``t``; its last value is unique and the smallest."""
    n = len(t)
    if n < 3:
        return np.arange(n - 1, -1, -1)
    small_array = smaller_types(t)
    leftmost = np.flatnonzero(small_array[1:] & ~small_array[:-1]) + 1
    counts = np.bincount(t)
    ends = np.cumsum(counts)
    heads, tails = (ends - counts).tolist(), ends.tolist()
    values, small = t.tolist(), small_array.tolist()

    # substrings: their starts at the ends of their buckets, in any order, then induced
    sa = [-1] * n
    _place(sa, leftmost, t, ends)
    _induce(values, small, heads, tails, sa)

    # names of the substrings in their order
    is_left = np.zeros(n, bool)
    is_left[leftmost] = True
    order = np.array(sa)
    order = order[is_left[order]]
    stop = np.empty(n, np.int64)
    stop[leftmost] = np.append(leftmost[1:], n - 1)
    fresh = _differs(t, order, stop)
    name = np.zeros(n, np.int64)
    name[order] = np.cumsum(fresh) - 1
    reduced = name[leftmost]
    kinds = int(fresh.sum())
    if kinds < len(leftmost):
        by_rank = leftmost[suffix_array(reduced)]
    else:
        by_rank = order

    sa = [-1] * n
    _place(sa, by_rank, t, ends)
    _induce(values, small, heads, tails, sa)
    return np.array(sa)


def _place(sa: list[int], positions: np.ndarray, t: np.ndarray, ends: np.ndarray) -> None:
    """Puts positions, in the given order, at the ends of their buckets."""
    symbol = t[positions]
    order = np.argsort(symbol, kind="stable")
    symbol, positions = symbol[order], positions[order]
    last = np.append(np.flatnonzero(np.diff(symbol)), len(symbol) - 1)
    size = np.diff(np.append(-1, last))
    slot = ends[symbol] - np.repeat(last, size) + np.arange(len(symbol)) - 1
    for i, p in zip(slot.tolist(), positions.tolist()):
        sa[i] = p


def _differs(t: np.ndarray, order: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Whether each substring in order differs from the one before (lengths, then
    values position by position for those still equal)."""
    out = np.ones(len(order), bool)
    if len(order) < 2:
        return out
    a, b = order[:-1], order[1:]
    size = stop[a] - a
    out[1:] = size != stop[b] - b
    live = np.flatnonzero(~out[1:])
    k = 0
    while len(live):
        bad = t[a[live] + k] != t[b[live] + k]
        out[live[bad] + 1] = True
        live = live[~bad]
        live = live[size[live] > k]
        k += 1
    return out


def permuted_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the symbols its suffix shares with the one before it in
    the order, computed in text order."""
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    values, phi = t.tolist(), before.tolist()
    out = [0] * n
    k = 0
    for i, j in enumerate(phi):
        if j < 0:
            k = 0
            continue
        # the unique last symbols end every match
        while values[i + k] == values[j + k]:
            k += 1
        out[i] = k
        if k:
            k -= 1
    return np.array(out)
