"""Random forest of regression trees over the coded blocks of the boosting.

Every tree draws its rows with replacement: how often a row counts is a Poisson number from a hash of the row's
key and the tree's number.  All features take part in every split, and a split is the one that lessens the sum of
squares most among all bin edges.  Some trees grow together, a level a job; targets are summed as whole numbers,
so a forest does not depend on the order of the rows.  A trained forest is stored and applied as a sum of trees.
"""

from __future__ import annotations

import math
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tripmeter.models.boosting import Binned, Boosted, Tree, added, binned_rows, ranks, remember, row_hashes
from tripmeter.models.coding import Codes, Coding, completed, halves

#: Trees that grow together.
TOGETHER = 5
#: Blocks of which a worker remembers where the rows of these trees are.
REMEMBERED = 32
_grown: OrderedDict[tuple, tuple[int, int, list[np.ndarray], list[np.ndarray]]] = OrderedDict()
#: Upper ends of the hashes that give 0, 1, 2, ... copies; the chance of 20 is below 1 in 2^61.
_COPIES = np.array([
    min(int(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2**64), 2**64 - 1) for k in range(20)
], np.uint64)


def copies(keys: np.ndarray, number: int, seed: int) -> np.ndarray:
    """How often a tree draws each row."""
    return np.searchsorted(_COPIES, row_hashes(keys, number, seed), side="right").astype(np.uint8)


@dataclass(frozen=True)
class Forest:
    """Settings: all rows drawn with replacement, all features at every split."""

    trees: int = 100
    depth: int = 10
    bins: int = 64
    seed: int = 42
    features: str = "features"
    target: str = "ATD"
    key: str = "trip_key"

    def getNumTrees(self) -> int:  # noqa: N802  the names of MLlib's forest
        return self.trees

    def getMaxDepth(self) -> int:  # noqa: N802
        return self.depth

    def getFeatureSubsetStrategy(self) -> str:  # noqa: N802
        return "all"

    def fit(self, rows: DataFrame, path: str | None = None, made: Binned | None = None) -> Boosted:
        """A model of all ``rows`` (feature vector, target, key), or of ``made`` from them; ``path`` is a new folder that all executors share."""
        own = made or binned_rows(rows, self.features, self.target, self.key, self.bins, path)
        if not own.n:
            return Boosted(0.0, [], self.features)
        if own.alone:
            base, scale, edges = own.base, own.scale, own.edges
            trees = own.blocks.mapPartitions(lambda found: [self._trees_of(list(found), base, scale, edges)]).first()
        else:
            trees = self._trees(own)
        if not made:
            own.release()
        return Boosted(0.0, trees, self.features)

    def _trees_of(self, blocks: list[tuple], base: float, scale: float, edges: list[np.ndarray]) -> list[Tree]:
        """All trees over the blocks of one task, one after the other."""
        coding = Coding.of_blocks([rows for rows, _, _ in blocks], edges)
        codes = [Codes(coding, coding.encode(rows)) for rows, _, _ in blocks]
        wholes = [np.rint((base - y) * scale) for _, y, _ in blocks]
        trees: list[Tree] = []
        for number in range(self.trees):
            weights = [copies(keys, number, self.seed) for _, _, keys in blocks]
            places = [c.begin(w > 0) for c, w in zip(codes, weights, strict=True)]

            def tables(grown: list[Tree], level: int, wanted: list[np.ndarray], weights=weights, places=places) -> np.ndarray:
                rank, out = ranks(wanted[0], level), 0
                for i, c in enumerate(codes):
                    if level:
                        places[i] = c.step(places[i], coding.moves(grown[0], level - 1))
                    out = out + c.histogram(places[i], rank, len(wanted[0]), wholes[i], weights[i])
                return out

            trees += self._grow(1, tables, base, scale, edges, coding)
        return trees

    def _trees(self, made: Binned) -> list[Tree]:
        """All trees, a few at once, every level of them a job over all blocks."""
        run, trees = uuid.uuid4().hex, []
        blocks, coding, base, scale = made.blocks, made.coding, made.base, made.scale
        for first in range(0, self.trees, TOGETHER):
            numbers = range(first, min(first + TOGETHER, self.trees))

            def tables(grown: list[Tree], level: int, wanted: list[np.ndarray], first=first, numbers=numbers) -> np.ndarray:
                above = [tree.above(level) for tree in grown]

                def histogram(found: Iterator) -> Iterator[np.ndarray]:
                    ends = np.cumsum([0, *map(len, wanted)])
                    out = np.zeros((ends[-1], coding.starts[-1], 2), np.int64)
                    rank = [ranks(w, level) for w in wanted]
                    moves: dict[tuple, tuple] = {}
                    for name, values, target, keys in found:
                        codes = Codes(coding, values)
                        whole = np.rint((base - target) * scale)
                        known = _grown.pop((run, name), None)
                        if known is None or known[0] != first or known[1] > level:
                            weights = [copies(keys, number, self.seed) for number in numbers]
                            known = first, 0, [codes.begin(w > 0) for w in weights], weights
                        places, weights = list(known[2]), known[3]
                        for t, tree in enumerate(above):
                            for i in range(known[1], level):
                                if (t, i) not in moves:
                                    moves[t, i] = coding.moves(tree, i)
                                places[t] = codes.step(places[t], moves[t, i])
                            if len(wanted[t]):
                                out[ends[t]:ends[t + 1]] += codes.histogram(places[t], rank[t], len(wanted[t]), whole, weights[t])
                        remember(_grown, (run, name), (first, level, places, weights), REMEMBERED)
                    yield out

                return added(blocks.mapPartitions(histogram))

            trees += self._grow(len(numbers), tables, base, scale, made.edges, coding)
        return trees

    def _grow(
        self, n: int, tables_of: Callable[[list[Tree], int, list[np.ndarray]], np.ndarray], base: float, scale: float,
        edges: list[np.ndarray], coding: Coding,
    ) -> list[Tree]:
        """``n`` trees, level by level; ``tables_of`` sums some places of a level of all of them, one tree after the other."""
        trees = [Tree.empty(self.depth) for _ in range(n)]
        sums = [np.zeros((len(tree.feature), 2)) for tree in trees]
        codes: list[np.ndarray | None] = [None] * n
        for level in range(self.depth):
            first = (1 << level) - 1
            chosen = [halves(tree, level, s[:, 1]) for tree, s in zip(trees, sums, strict=True)]
            ends = np.cumsum([0, *[len(wanted) for wanted, _ in chosen]])
            if not ends[-1]:
                break
            counted = tables_of(trees, level, [wanted for wanted, _ in chosen])
            for t, (tree, (wanted, parents)) in enumerate(zip(trees, chosen, strict=True)):
                codes[t] = completed(level, counted[ends[t]:ends[t + 1]], wanted, parents, codes[t])
                gain, feature, cut, missing_left, left = splits(codes[t], scale, edges, coding)
                if not level:
                    own = coding.feature(codes[t], 0, len(edges[0]) + 2)
                    sums[t][0] = own[0].sum(axis=0) / np.array([scale, 1.0])
                split = np.flatnonzero(gain > 1e-9)
                nodes = first + split
                tree.feature[nodes], tree.cut[nodes], tree.missing_left[nodes] = feature[split], cut[split], missing_left[split]
                tree.gain[nodes] = gain[split]
                tree.threshold[nodes] = [edges[f][c] if c < len(edges[f]) else np.inf for f, c in zip(feature[split], cut[split], strict=True)]
                sums[t][2 * nodes + 1] = left[split]
                sums[t][2 * nodes + 2] = sums[t][nodes] - left[split]
        for tree, s in zip(trees, sums, strict=True):
            mean = base - s[:, 0] / np.maximum(s[:, 1], 1)
            # A node below a leaf is never reached; a tree that draws no row at all says the mean.
            here = (tree.feature < 0) & (s[:, 1] > 0)
            here[0] |= tree.feature[0] < 0
            tree.weight = np.where(here, mean / self.trees, 0.0)
        return trees


def splits(table: np.ndarray, scale: float, edges: list[np.ndarray], coding: Coding) -> tuple[np.ndarray, ...]:
    """For each node: gain, feature, cut, side of missing values, and gradient and rows on the left; ties by feature, then cut."""
    n = len(table)
    every = np.arange(n)
    best = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros((n, 2))
    for f, own in enumerate(edges):
        sums = coding.feature(table, f, len(own) + 2) / np.array([scale, 1.0])
        total = sums.sum(axis=1)[:, None]
        below = sums[:, :-1].cumsum(axis=1)
        for side in (True, False) if sums[:, -1, 1].any() else (True,):
            left = below + sums[:, -1:] if side else below
            right = total - left
            gain = 0.5 * (_score(left) + _score(right) - _score(total))
            gain[(left[..., 1] < 1) | (right[..., 1] < 1)] = -np.inf
            # Equal up to rounding counts as equal, so the first one stands for all.
            top = gain.max(axis=1)
            cut = (gain >= np.where(np.isfinite(top), top * (1 - 1e-12) - 1e-12, np.inf)[:, None]).argmax(axis=1)
            better = np.isfinite(top) & (top > best[0] * (1 + 1e-12) + 1e-12)
            for kept, new in zip(best, (gain[every, cut], np.full(n, f), cut, np.full(n, side), left[every, cut]), strict=True):
                kept[better] = new[better]
    return best


def _score(x: np.ndarray) -> np.ndarray:
    return x[..., 0] ** 2 / np.maximum(x[..., 1], 1e-300)
