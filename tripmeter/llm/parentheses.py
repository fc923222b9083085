"""Trees as balanced parentheses, with a range min-max tree over the excess."""

from __future__ import annotations

import numpy as np

#: Parentheses in a block of the range min-max tree.
BLOCK = 64


class Parentheses:
    """A tree (or forest) in preorder: ``opens[i]`` is the place of the parenthesis that opens node i."""

    def __init__(self, is_open: np.ndarray) -> None:
        self.is_open = is_open
        self.opens = np.flatnonzero(is_open)
        self.rank = np.concatenate([[0], np.cumsum(is_open, dtype=np.int64)])
        pairs = np.zeros(len(is_open), bool)
        pairs[:-1] = is_open[:-1] & ~is_open[1:]
        self.leaf_rank = np.concatenate([[0], np.cumsum(pairs, dtype=np.int64)])
        blocks = max(1, -(-len(is_open) // BLOCK))
        # Excess after each parenthesis; what is beyond the end never closes anything.
        self.excess = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        self.excess[: len(is_open)] = np.cumsum(np.where(is_open, 1, -1), dtype=np.int32)
        # Level 0 holds the least excess of each block, each level above that of pairs of the one below.
        self.levels = [self.excess.reshape(blocks, BLOCK).min(axis=1)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = np.append(below, np.iinfo(np.int32).max)
                self.levels[-1] = below
            self.levels.append(below.reshape(-1, 2).min(axis=1))

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Where the given parentheses close: the first place after each with a smaller excess."""
        out = np.empty(len(opens), np.int64)
        for begin in range(0, len(opens), 1 << 14):
            out[begin:begin + (1 << 14)] = self._find_close(opens[begin:begin + (1 << 14)])
        return out

    def _first_below(self, block: np.ndarray, bound: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The first place of each block behind ``after`` whose excess is below the bound, -1 without."""
        places = block[:, None] * BLOCK + np.arange(BLOCK)
        low = (self.excess[places] < bound[:, None]) & (places > after[:, None])
        return np.where(low.any(axis=1), block * BLOCK + low.argmax(axis=1), -1)

    def _find_close(self, opens: np.ndarray) -> np.ndarray:
        bound = self.excess[opens]
        block = opens // BLOCK
        out = self._first_below(block, bound, opens)
        rest = np.flatnonzero(out < 0)
        if not len(rest):
            return out
        # Up the tree until the right neighbour has a smaller excess, then down to the block.
        node, least = block[rest].copy(), bound[rest]
        level = np.zeros(len(rest), np.int64)
        found = np.zeros(len(rest), bool)
        for height, row in enumerate(self.levels):
            open_ = np.flatnonzero(~found)
            sibling = node[open_] ^ 1
            hit = (node[open_] % 2 == 0) & (sibling < len(row))
            hit[hit] = row[sibling[hit]] < least[open_[hit]]
            node[open_[hit]] = sibling[hit]
            level[open_[hit]] = height
            found[open_[hit]] = True
            node[open_[~hit]] >>= 1
        for height in range(len(self.levels) - 1, 0, -1):
            there = np.flatnonzero(level == height)
            left = node[there] * 2
            node[there] = np.where(self.levels[height - 1][left] < least[there], left, left + 1)
            level[there] = height - 1
        out[rest] = self._first_below(node, least, np.full(len(rest), -1))
        return out

    def subtree_ends(self) -> np.ndarray:
        """For each node in preorder the number of the first node behind its subtree."""
        return self.rank[self.find_close(self.opens)]

    def leaves(self, close: np.ndarray) -> np.ndarray:
        """Leaf pairs inside each node's parentheses."""
        return self.leaf_rank[close] - self.leaf_rank[self.opens]
