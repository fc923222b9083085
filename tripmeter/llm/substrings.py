"""Substring deduplication of words by relative Lempel-Ziv parsing.

The runs of a shard are its reference block, indexed by a suffix array over their words.  Each run
is parsed greedily into its longest factors that stand elsewhere in the block; the windows inside a
factor of the window's length or more repeat, and windows across the border of two factors are
looked up one by one, as a longer match may begin inside a factor.  Since a run's windows can repeat
only in the block of its anchor, parsing against that block is parsing against all of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tripmeter.llm.repeats import Scheme, Shard, SingleSpaced, per_document, repeated_spans
from tripmeter.llm.suffixes import common_prefixes, suffix_array

WINDOW = 35
GRAM = 6


class ReferenceBlock:
    """The runs of a shard as words, and how far each place matches another place of the block."""

    def __init__(self, contents: list[bytes], most: int) -> None:
        symbols = SingleSpaced(contents)
        self.sizes = symbols.counts
        words, codes = np.unique(symbols.hashes(), return_inverse=True)
        # A sign of its own behind each run, so that no factor crosses from run to run.
        self.begins = symbols.first[:-1] + np.arange(len(contents))
        data = np.empty(len(codes) + len(contents), np.int64)
        data[np.arange(len(codes)) + symbols.owner()] = codes
        data[self.begins + self.sizes] = len(words) + np.arange(len(contents))
        bits = max(1, int(len(words) + len(contents)).bit_length())
        packed, known = data.copy(), 1
        while (known + 1) * bits <= 62 and known < 3:
            packed = packed << bits
            packed[: len(data) - known] |= data[known:]
            known += 1
        order, _ = suffix_array(packed, known)
        prefixes = common_prefixes(data, order[data[order] < len(words)], self.begins, self.begins + self.sizes, most)
        inner = order[data[order] < len(words)]
        self.match = prefixes
        self.match[inner[:-1]] = np.maximum(prefixes[inner[:-1]], prefixes[inner[1:]].copy())


def factors(block: ReferenceBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy parse of all runs side by side: run, first word and length of each factor (1 where nothing matches)."""
    run, first, length = [], [], []
    lanes = np.arange(len(block.sizes))
    at = np.zeros(len(lanes), np.int64)
    while True:
        going = at < block.sizes[lanes]
        lanes, at = lanes[going], at[going]
        if not len(lanes):
            break
        size = np.maximum(1, np.minimum(block.match[block.begins[lanes] + at], block.sizes[lanes] - at))
        run.append(lanes)
        first.append(at)
        length.append(size)
        at = at + size
    if not run:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(run), np.concatenate(first), np.concatenate(length)


def repeated_windows(size: int):
    """Which windows of each run also stand elsewhere in the shard."""

    def repeated(shard: Shard) -> list[np.ndarray]:
        # Matches longer than a run are cut at its end, so no run has to be followed further.
        block = ReferenceBlock(shard.contents, int(shard.counts.max()) + size)
        run, first, length = factors(block)
        starts = np.cumsum(shard.counts) - shard.counts
        total = int(shard.counts.sum())
        long = length >= size
        steps = np.zeros(total + 1, np.int64)
        np.add.at(steps, starts[run[long]] + first[long], 1)
        np.add.at(steps, starts[run[long]] + first[long] + length[long] - size + 1, -1)
        inside = np.cumsum(steps[:-1]) > 0
        # Windows across a border of factors.
        rest = np.flatnonzero(~inside)
        owner = np.repeat(np.arange(len(shard.counts)), shard.counts)[rest]
        inside[rest] = block.match[block.begins[owner] + rest - starts[owner]] >= size
        return np.split(inside, starts[1:])

    return repeated


def removed_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Documents in blocks, and spans of words inside a window of words that also stands elsewhere."""
    return repeated_spans(docs, Scheme(SingleSpaced, window, gram, first_too=True), repeated_windows(window), *keep)


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, *keep: str) -> DataFrame:
    """``doc_id, n_words, spans, kept``: each document's removed word ranges and the words that remain.

    A word goes if it lies in ``window`` consecutive words that also start anywhere else, in the same
    document or another; the remaining words are joined by single spaces.  A null text has no words;
    rows that repeat count as different documents, and give a row each.  Of other columns
    only ``keep`` are read and returned.
    """
    dealt, spans = removed_spans(docs, window, gram, *keep)

    def make(texts, found):
        words = [(t or b"").split() for t in texts]
        kept = [
            b" ".join(x for a, b in zip([0, *s[1].tolist()], [*s[0].tolist(), len(w)], strict=True) for x in w[a:b])
            for w, s in zip(words, found, strict=True)
        ]
        return [
            [len(w) for w in words],
            [[{"begin": a, "end": b} for a, b in zip(s[0].tolist(), s[1].tolist(), strict=True)] for s in found],
            [k.decode("utf-8", "replace") for k in kept],
        ]

    return per_document(dealt, spans, make, "n_words bigint, spans array<struct<begin:int,end:int>>, kept string")
