"""Suffix arrays and common prefixes of moderate arrays of symbols, in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(codes: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes and the rank of each, by Larsson-Sadakane refinement.

    ``codes[i]`` orders suffix i by its first ``symbols`` symbols.  Each round sorts the groups that
    are still equal by the rank of what follows the known part, which doubles that part; groups of
    one are never touched again.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    sorted_codes = codes[order]
    head = np.ones(n, bool)
    head[1:] = sorted_codes[1:] != sorted_codes[:-1]
    del sorted_codes
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    # Places in ``order`` whose group has more than one member.
    alone = head.copy()
    alone[:-1] &= head[1:]
    open_places = np.flatnonzero(~alone)
    known = symbols
    while len(open_places):
        suffixes = order[open_places]
        group = rank[suffixes]
        after = suffixes + known
        following = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(group * (n + 1) + following, kind="stable")
        suffixes, group, following = suffixes[by], group[by], following[by]
        order[open_places] = suffixes
        head = np.ones(len(by), bool)
        head[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        rank[suffixes] = np.maximum.accumulate(np.where(head, open_places, 0))
        alone = head.copy()
        alone[:-1] &= head[1:]
        open_places = open_places[~alone]
        known *= 2
    return order, rank


def common_prefixes(data: np.ndarray, ordered: np.ndarray, begins: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix in ``ordered`` with the one before it, at most ``most``, by Kasai's rule.

    ``ordered`` lists, sorted, the suffixes that start in the ranges ``[begins, ends)``.  Going from
    suffix i to i + 1 loses at most one symbol if the one before i also moves on within its range, so
    the known part is not compared again.  The rule runs in all ranges side by side.  The result is
    indexed by suffix.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[ordered[1:]] = ordered[:-1]
    goes_on = np.zeros(n + 1, bool)  # whether the next symbol is in a range, too
    goes_on[ordered] = True
    goes_on = goes_on[1:] & goes_on[:-1]
    goes_on[ends - 1] = False
    prefixes = np.zeros(n, np.int64)
    lengths = ends - begins
    lanes = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[lanes], lengths[lanes]
    got = np.zeros(len(begins), np.int64)
    for step in range(int(lengths.max(initial=0))):
        live = int(np.searchsorted(-lengths, -step))
        at = begins[:live] + step
        got = got[:live]
        if step:
            last = before[at - 1]
            got = np.where((last >= 0) & goes_on[last], np.maximum(got - 1, 0), 0)
        other = before[at]
        got[other < 0] = 0
        growing = np.flatnonzero((other >= 0) & (got < most))
        while len(growing):
            here, there = at[growing] + got[growing], other[growing] + got[growing]
            inside = np.maximum(here, there) < n
            growing, here, there = growing[inside], here[inside], there[inside]
            growing = growing[data[here] == data[there]]
            got[growing] += 1
            growing = growing[got[growing] < most]
        prefixes[at] = got
    return prefixes


def merge(sorted_left: np.ndarray, sorted_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in two sorted lists of distinct strings that hold the same string, by binary search."""
    if not len(sorted_left) or not len(sorted_right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(sorted_left, sorted_right), len(sorted_left) - 1)
    same = np.flatnonzero(sorted_left[at] == sorted_right)
    return at[same], same
