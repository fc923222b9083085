"""Binned rows as a few bytes: features of few bins that occur together are numbered together.

One-hot columns, flags and the parts of one clock have few combinations in all rows, so one code stands for
many features, and a histogram of the codes holds the histograms of them all.  Which features share a code is
proposed from one block of rows and checked on all of them; it changes the work, never a sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import TYPE_CHECKING

import numpy as np

if TYPE_CHECKING:
    from tripmeter.models.boosting import Tree

MISSING = 255  # the bin of missing values; there may be 254 others
#: Combinations that one code may have, and that a proposal from one block may have.
MOST, PROPOSED = 254, 200
#: Groups that a further feature is tried with.
TRIED = 4


def propose(rows: np.ndarray) -> list[list[int]]:
    """Groups of features with few combinations in these rows, features of few bins first."""
    bins = [np.count_nonzero(np.bincount(rows[:, f], minlength=256)) for f in range(rows.shape[1])]
    groups: list[list[int]] = []
    codes: list[np.ndarray] = []
    for f in sorted(range(rows.shape[1]), key=lambda f: (bins[f], f)):
        for i in range(max(0, len(groups) - TRIED), len(groups)):
            code, n = _joined(codes[i], rows[:, f])
            if n <= PROPOSED:
                groups[i].append(f)
                codes[i] = code
                break
        else:
            groups.append([f])
            codes.append(_joined(np.zeros(len(rows), np.int32), rows[:, f])[0])
    return groups


def _joined(code: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, int]:
    key = code * 256 + bins
    seen = np.bincount(key) > 0
    return (np.cumsum(seen, dtype=np.int32) - 1)[key], int(seen.sum())


def combinations(rows: np.ndarray, members: Sequence[int]) -> np.ndarray:
    """The distinct bins of some features, a row each: of as many of them, in order, as one code may stand for."""
    code, found = np.zeros(len(rows), np.int32), np.zeros((1, 0), np.uint8)
    for f in members:
        key = code * 256 + rows[:, f]
        seen = np.bincount(key, minlength=256) > 0
        present = np.flatnonzero(seen)
        if len(present) > MOST:
            break
        code = (np.cumsum(seen, dtype=np.int32) - 1)[key]
        found = np.hstack([found[present // 256], (present % 256).astype(np.uint8)[:, None]])
    return found


def united(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The combinations of two sets of rows, again of as many features as one code may stand for."""
    k = min(a.shape[1], b.shape[1])
    found = np.unique(np.vstack([a[:, :k], b[:, :k]]), axis=0)
    while len(found) > MOST:
        found = np.unique(found[:, :-1], axis=0)
    return found


@dataclass(frozen=True)
class Coding:
    """Columns of codes: the features of each (``members``), and the bin of each feature for each code (``bins``)."""

    members: tuple[tuple[int, ...], ...]
    bins: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, groups: Sequence[Sequence[int]], found: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> Coding:
        """``found`` has the combinations of the first features of each group in all rows; the others get a column each."""
        members: list[tuple[int, ...]] = []
        bins: list[np.ndarray] = []
        for group, known in zip(groups, found, strict=True):
            together = known.shape[1] if known.shape[1] > 1 else 0
            if together:
                members.append(tuple(group[:together]))
                bins.append(known)
            for f in group[together:]:
                members.append((f,))
                bins.append(np.append(np.arange(len(edges[f]) + 1), MISSING).astype(np.uint8)[:, None])
        return cls(tuple(members), tuple(bins))

    @classmethod
    def of_blocks(cls, blocks: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> Coding:
        groups = propose(blocks[0])
        return cls.of(groups, [reduce(united, [combinations(b, g) for b in blocks]) for g in groups], edges)

    @cached_property
    def starts(self) -> np.ndarray:
        """Where the codes of each column begin in a histogram; the last is its length."""
        return np.cumsum([0, *[len(b) for b in self.bins]])

    @cached_property
    def column(self) -> np.ndarray:
        """The column of each feature."""
        out = np.zeros(sum(map(len, self.members)), np.int64)
        for i, group in enumerate(self.members):
            out[list(group)] = i
        return out

    @cached_property
    def bin_of(self) -> np.ndarray:
        """The bin of each feature by code of its column."""
        out = np.zeros((len(self.column), 256), np.uint8)
        for group, known in zip(self.members, self.bins, strict=True):
            out[list(group), :len(known)] = known.T
        return out

    @cached_property
    def _numbers(self) -> list[list[np.ndarray]]:
        """For each column, feature by feature: the number of each (number so far, bin)."""
        out = []
        for known in self.bins:
            tables, before = [], np.zeros(len(known), np.int64)
            for j in range(known.shape[1]):
                prefixes, now = np.unique(known[:, :j + 1], axis=0, return_inverse=True)
                table = np.zeros(256 * 256, np.uint8)
                table[before * 256 + known[:, j]] = now.reshape(-1)
                tables.append(table)
                before = now.reshape(-1)
            out.append(tables)
        return out

    def encode(self, rows: np.ndarray) -> np.ndarray:
        """Columns by rows."""
        out = np.empty((len(self.members), len(rows)), np.uint8)
        for i, (group, tables) in enumerate(zip(self.members, self._numbers, strict=True)):
            code = np.zeros(len(rows), np.int32)
            for f, table in zip(group, tables, strict=True):
                code = table.take((code.astype(np.int32) << 8) + rows[:, f])
            out[i] = code
        return out

    def feature(self, table: np.ndarray, f: int, width: int) -> np.ndarray:
        """(nodes, ``width``, ...) of one feature from (nodes, codes, ...): bins in order, missing values last."""
        i = self.column[f]
        own, slots = table[:, self.starts[i]:self.starts[i + 1]], self.bins[i][:, self.members[i].index(f)]
        out = np.zeros((len(table), width, *table.shape[2:]), table.dtype)
        if len(self.members[i]) == 1:
            out[:, :own.shape[1] - 1], out[:, -1] = own[:, :-1], own[:, -1]
            return out
        for b in np.unique(slots):
            out[:, -1 if b == MISSING else b] = own[:, slots == b].sum(axis=1)
        return out

    def moves(self, tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray]:
        """For each node of a level the column to look at, and by code the place in the next level; leaves lead out of it."""
        count = 1 << level
        nodes = slice(count - 1, 2 * count - 1)
        feature = tree.feature[nodes]
        bins = self.bin_of[np.maximum(feature, 0)]
        left = np.where(bins == MISSING, tree.missing_left[nodes][:, None], bins <= tree.cut[nodes][:, None])
        following = np.where(feature[:, None] >= 0, 2 * np.arange(count)[:, None] + 1 - left, 2 * count)
        after = np.vstack([following, np.full((1, 256), 2 * count)]).astype(np.uint16 if level < 14 else np.uint32)
        return np.append(self.column[np.maximum(feature, 0)], 0), after.reshape(-1)


@dataclass(frozen=True)
class Codes:
    """The coded rows of a block."""

    coding: Coding
    values: np.ndarray

    def __len__(self) -> int:
        return self.values.shape[1]

    def begin(self, drawn: np.ndarray) -> np.ndarray:
        """Places in level 0; a row that is not drawn is in no node."""
        return np.where(drawn, 0, 1).astype(np.uint16)

    def step(self, at: np.ndarray, moves: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Places in the next level from those of one level."""
        column, after = moves
        if len(column) == 2:  # one node: all rows look at one column
            code = self.values[column[0]]
        else:
            code = self.values.reshape(-1).take((column * len(self)).take(at) + np.arange(len(self)))
        return after.take((at.astype(np.int32) << 8) + code)

    def nodes_of(self, tree: Tree, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` splits."""
        at, node = np.zeros(len(self), np.uint16), np.zeros(len(self), np.int64)
        for level in range(levels):
            at = self.step(at, self.coding.moves(tree, level))
            here = at < 2 << level
            node = np.where(here, at + ((2 << level) - 1), node)
        return node

    def histogram(self, at: np.ndarray, rank: np.ndarray, count: int, value: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        """(count, codes, 2): whole values and rows by code of the rows whose place has a ``rank``; ``weight`` counts a row more than once."""
        starts = self.coding.starts
        out = np.empty((count, starts[-1], 2), np.int64)
        place = rank.take(at)
        use = np.flatnonzero(place >= 0)
        every = len(use) == len(place)
        place, value = (place, value) if every else (place.take(use), value.take(use))
        times = None
        if weight is not None:
            times = weight.take(use).astype(float)
            value = value * times
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            code = self.values[i] if every else self.values[i].take(use)
            slot = place * (b - a) + code
            out[:, a:b, 0] = np.bincount(slot, value, count * (b - a)).astype(np.int64).reshape(count, -1)
            out[:, a:b, 1] = np.bincount(slot, times, count * (b - a)).astype(np.int64).reshape(count, -1)
        return out


def halves(tree: Tree, level: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a level that are to be counted, and for each place of it the place it is counted from.

    Of the two sides of a split the one with fewer rows is counted; the other is what its node has more.
    ``rows`` are the rows of all nodes.
    """
    if not level:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    first = (1 << level) - 1
    parents = np.flatnonzero(tree.feature[(first - 1) // 2:first] >= 0)
    left = rows[first + 2 * parents] <= rows[first + 2 * parents + 1]
    return 2 * parents + np.where(left, 0, 1), parents


def completed(level: int, counted: np.ndarray, wanted: np.ndarray, parents: np.ndarray, above: np.ndarray | None) -> np.ndarray:
    """Histograms of all places of a level from those of ``wanted`` and of the level above."""
    if not level:
        return counted
    out = np.zeros((1 << level, *counted.shape[1:]), np.int64)
    out[wanted] = counted
    out[wanted ^ 1] = above[parents] - counted
    return out
