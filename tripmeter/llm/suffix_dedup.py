"""Substring deduplication of bytes by suffix arrays.

The runs of a shard are laid one after the other and sorted as suffixes; windows that follow each
other in that order with a common prefix of the window's length are equal, and all but the first
occurrence go.  Parts of an anchor that is split have suffix arrays of their own, whose sorted
windows are merged by binary search.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tripmeter.llm.repeats import Bytes, Scheme, Shard, per_document, repeated_spans
from tripmeter.llm.suffixes import common_prefixes, merge, suffix_array

WINDOW = 100
GRAM = 32


class SortedWindows:
    """Windows of some runs in the order of their bytes.

    ``run`` and ``place`` name each window of the sorted list, ``group`` numbers equal ones from 0,
    ``least`` is the smallest order of a run in each group.
    """

    def __init__(self, shard: Shard, which: np.ndarray, size: int) -> None:
        contents = [shard.contents[i] for i in which]
        lengths = np.array([len(c) for c in contents], np.int64)
        begins = np.cumsum(lengths) - lengths
        n = int(lengths.sum())
        whole = b"".join(contents) + bytes(8)
        self.data = np.frombuffer(whole, np.uint8)[:n]
        counts = shard.counts[which]
        # The first eight bytes of each suffix as one number.
        order, _ = suffix_array(np.array(np.ndarray((n,), ">u8", whole, 0, (1,))).astype(np.uint64), 8)
        owner = np.full(n, -1, np.int64)
        starts = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        owner[starts] = np.repeat(np.arange(len(which)), counts)
        self.at = order[owner[order] >= 0]
        prefixes = common_prefixes(self.data, self.at, begins, begins + counts, size)
        self.group = np.cumsum(prefixes[self.at] < size) - 1
        local = owner[self.at]
        self.run, self.place = which[local], self.at - begins[local]
        self.heads = np.flatnonzero(np.diff(self.group, prepend=-1))
        self.least = np.minimum.reduceat(shard.order[self.run], self.heads) if len(self.heads) else self.heads

    def strings(self, size: int) -> np.ndarray:
        """The different windows, sorted."""
        rows = np.lib.stride_tricks.sliding_window_view(self.data, size)[self.at[self.heads]]
        return np.ascontiguousarray(rows).view(f"S{size}")[:, 0]


def later_windows(size: int):
    """Which windows of each run start earlier elsewhere."""

    def repeated(shard: Shard) -> list[np.ndarray]:
        parts = [SortedWindows(shard, np.flatnonzero(shard.part == p), size) for p in np.unique(shard.part)]
        if len(parts) == 2:
            left, right = parts
            a, b = merge(left.strings(size), right.strings(size))
            least = np.minimum(left.least[a], right.least[b])
            left.least[a] = right.least[b] = least
        begins = np.cumsum(shard.counts) - shard.counts
        flat = np.zeros(int(shard.counts.sum()), bool)
        for own in parts:
            flat[begins[own.run] + own.place] = shard.order[own.run] > own.least[own.group]
        return np.split(flat, begins[1:])

    return repeated


def removed_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Documents in blocks, and spans of bytes inside a string of ``window`` bytes that starts earlier."""
    return repeated_spans(docs, Scheme(Bytes, window, gram, first_too=False), later_windows(window), *keep)


def kept_bytes(text: bytes, spans: tuple[np.ndarray, np.ndarray]) -> bytes:
    """What is left of a text without its spans."""
    begins, ends = spans
    return b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(text)], strict=True))


def kept_text(text: bytes, spans: tuple[np.ndarray, np.ndarray]) -> str:
    """What is left of a text as text; of a character that was cut nothing stays, and no two rests make another."""
    begins, ends = spans
    pieces = zip([0, *ends.tolist()], [*begins.tolist(), len(text)], strict=True)
    return "".join(text[a:b].decode("utf-8", "ignore") for a, b in pieces)


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, *keep: str, readable: bool = False) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: each document's removed byte ranges and the bytes that remain.

    A byte goes if it lies in a string of ``window`` bytes that also starts earlier: in a document
    with a smaller id (null ids come first; documents that share an id are ordered by a hash of the
    text, and equal ones one after the other), or earlier in the same document.  A null text counts
    as empty; texts shorter than ``window`` are never cut, yet rows that repeat give a row each.
    Of other columns only ``keep`` are
    read and returned.  ``readable`` gives ``kept`` as text, without the rest of characters that were cut.
    """
    dealt, spans = removed_spans(docs, window, gram, *keep)
    left, kind = (kept_text, "string") if readable else (kept_bytes, "binary")

    def make(texts, found):
        texts = [t or b"" for t in texts]
        return [
            [len(t) for t in texts],
            [[{"begin": a, "end": b} for a, b in zip(s[0].tolist(), s[1].tolist(), strict=True)] for s in found],
            [left(t, s) for t, s in zip(texts, found, strict=True)],
        ]

    return per_document(dealt, spans, make, f"n_bytes bigint, spans array<struct<begin:int,end:int>>, kept {kind}")
