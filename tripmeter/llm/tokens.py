"""Token counts by dynamic programming over prefixes.

For byte pair encoding the last token of a prefix decides everything: token t ends the encoding of
``b[:i]`` exactly when it is a suffix of ``b[:i]`` and the last token of ``b[:i - len(t)]`` may stand
before it (re-encoding the two tokens gives them back).  So one pass over a text gives the exact
number of tokens of every prefix, and questions such as "where must this be cut to hold 512 tokens"
need no second encoding.

A text falls into units (white space and the run that follows it).  The pattern that splits texts
before the merges never looks back, so the count of a unit does not depend on its neighbours and
is remembered: the counts of all its prefixes that end between characters, as runs of equal
counts.  The table of a text is those of its units, moved by running sums of bytes and tokens.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmeter.llm.texts import id_and_text, map_texts

#: Units that one worker remembers in each of two generations. It bounds memory only: a forgotten unit is counted again.
REMEMBERED = 300_000
#: Pieces that one worker remembers in each of two generations, likewise.
PIECES = 200_000
#: Longer units and pieces are counted each time they occur.
SHORT = 64
#: Bytes of one run of equal counts.
RUN = 12

_UNIT = re.compile(r"\s*\S+|\s+")
#: White space other than space and line feed; Python and the pattern differ on the last four of the first line.
_ASCII_WHITE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_OTHER_WHITE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RARE = re.compile("[\x1c-\x1f]")


def _uneven(part: str) -> bool:
    """Whether cutting at single spaces could part white space that belongs together."""
    return (
        "  " in part
        or " \n" in part
        or "\n " in part
        or any(c in part for c in _ASCII_WHITE)
        or not part.isascii() and any(c in part for c in _OTHER_WHITE)
    )


class PrefixCounter:
    """Exact token counts of all prefixes for a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        import json

        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        split = told.get("pre_tokenizer") or {}
        if told["model"]["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or told.get("normalizer"):
            raise ValueError("only byte-level BPE without a prefix space or a normalizer is supported")
        self.specials = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        vocabulary = told["model"]["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in told["model"]["merges"]]
        # Ranks: bytes first, then merges in their order.
        self.rank = {c: i for i, c in enumerate(letters)}
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(len(letters))]
        self.joined: dict[tuple[int, int], int] = {}
        for left, right in merges:
            pair = self.rank[left], self.rank[right]
            self.joined.setdefault(pair, len(self.parts))
            self.rank.setdefault(left + right, len(self.parts))
            self.parts.append(pair)
        if len(self.rank) != len(self.parts) or not set(self.rank) <= set(vocabulary):
            raise ValueError("every merge must make a token of its own")
        self.sizes = [0] * len(self.parts)
        self.tokens = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.rank.items():
            raw = bytes(letters[c] for c in token).decode("latin-1")
            self.sizes[rank] = len(raw)
            self.tokens.add_word(raw, rank)
        self.tokens.make_automaton()
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.white = regex.compile(r"\s*")
        #: Units by the pattern's own white space, for texts in which Python's differs.
        self.rare_unit = regex.compile(r"\s*\S+|\s+")
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.fits: dict[int, bool] = {}
        self.units: list[dict[str, bytes]] = [{}, {}]
        self.spaced: list[dict[str, bytes]] = [{}, {}]
        self.pieces: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens, encoded together, stay these two."""
        key = left << 20 | right
        a, b, before = left, right, len(self.parts)
        while True:
            # Would a merge across the border come before the ones that made a and b?
            across = self.joined.get((a, b), before)
            if across < before:
                answer = False
                break
            # Undo the later of the two: its outer part leaves the border.
            if a > b:
                before, (first, last) = a, self.parts[a]
                if first == last == a:
                    answer = True
                    break
                a = last
            else:
                first, last = self.parts[b]
                if first == last == b:
                    first, last = self.parts[a]
                    if first == last == a:
                        answer = True
                        break
                    before, a = a, last
                else:
                    before, b = b + 1, first
        if len(self.fits) > 4 * REMEMBERED:
            self.fits.clear()
        self.fits[key] = answer
        return answer

    def piece(self, raw: bytes) -> list[int]:
        """Counts of all prefixes of one piece, from the empty one on."""
        n = len(raw)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        sizes, known = self.sizes, self.fits.get
        for end, rank in self.tokens.iter(raw.decode("latin-1")):
            end += 1
            if last[end] < 0:
                begin = end - sizes[rank]
                if not begin:
                    last[end], count[end] = rank, 1
                    continue
                before = last[begin]
                fits = known(before << 20 | rank)
                if fits is None:
                    fits = self.may_follow(before, rank)
                if fits:
                    last[end], count[end] = rank, count[begin] + 1
        return count

    def unit_prefixes(self, text: str) -> tuple[list[int], list[int]]:
        """Byte lengths and counts of all prefixes of a unit that end between characters."""
        white = self.white.match(text).end()
        lengths, counts = [0], [0]
        dp = self.piece(text[:white].encode())
        size = 0
        for c in text[:white]:
            size += len(c.encode())
            lengths.append(size)
            counts.append(dp[size])
        at = total = 0
        for p in self.split.findall(text):
            raw = p.encode()
            dp = self.piece(raw)
            cut = size_in = 0
            for c in p:
                cut += 1
                size_in += len(c.encode())
                if at + cut > white:
                    lengths.append(lengths[-1] + len(c.encode()))
                    # "'ll" cut short is an apostrophe and a letter.
                    short = p[0] == "'" and 1 < cut < len(p) and p[1].isalpha()
                    counts.append(total + (sum(self.piece(x.encode())[-1] for x in ("'", p[1:cut])) if short else dp[size_in]))
            at += len(p)
            total += dp[-1]
        return lengths, counts

    def piece_runs(self, text: str) -> bytes:
        """Runs of equal counts in one piece."""
        new, old = self.pieces
        found = new.get(text) or old.get(text)
        if found is None:
            raw = text.encode()
            counts = self.piece(raw)
            if len(raw) == len(text):
                found = _runs(range(len(counts)), counts)
            else:
                lengths = [i for i, byte in enumerate(raw) if byte & 0xC0 != 0x80]
                lengths.append(len(raw))
                found = _runs(lengths, [counts[n] for n in lengths])
        elif text in new:
            return found
        if len(text) <= SHORT:
            if len(new) >= PIECES:
                self.pieces = {}, new
            self.pieces[0][text] = found
        return found

    def unit_runs(self, text: str) -> bytes:
        """Runs of equal counts in a unit: bytes of the first and of the last prefix, and their tokens."""
        # The usual unit: at most one white character and that in front, no "'ll" that a cut could part.
        # A prefix of such a unit falls into the same pieces, the last one cut short.
        if not text[1:2].isspace() and text.find("\n", 1) < 0:
            pieces = self.split.findall(text)
            if "'" not in text or not any(p[0] == "'" and len(p) > 2 for p in pieces):
                return _chained([self.piece_runs(p) for p in pieces])
        # What is cut at single spaces only may hold line feeds.
        own = self._split(text)
        if len(own) == 1:
            return _runs(*self.unit_prefixes(text))
        return _chained([self.unit_runs(unit) for unit in own])

    def special_runs(self, before: str, special: str) -> bytes:
        """Runs in a special string that comes after the unit ``before``.

        It is one token as a whole; a part of it is plain text that goes on from that unit.
        """
        lengths, counts = [0], [0]
        known = self.count(before) if before else 0
        for cut in range(1, len(special) + 1):
            lengths.append(len(special[:cut].encode()))
            counts.append(1 if cut == len(special) else self.count(before + special[:cut]) - known)
        return _runs(lengths, counts)

    def _known(self, stores: list[dict[str, bytes]], prefix: str, keys: list[str]) -> list[bytes]:
        found = list(map(stores[0].get, keys))
        for i in [i for i, n in enumerate(found) if n is None]:
            new, old = stores
            key = keys[i]
            n = new.get(key)
            if n is None:
                n = old.get(key)
                if n is None:
                    n = self.unit_runs(prefix + key)
                if len(key) <= SHORT:
                    if len(new) >= REMEMBERED:
                        stores[:] = {}, new
                    stores[0][key] = n
            found[i] = n
        return found

    def parts_of(self, text: str) -> list[bytes]:
        """The runs of each unit of a text in their order."""
        found: list[bytes] = []
        before = ""
        special = any(s in text for s in self.specials)
        for i, part in enumerate(self.special.split(text) if special else [text]):
            if i % 2:
                found.append(self.special_runs(before, part))
                before = ""
            elif part and not _uneven(part):
                first, *rest = part.split(" ")
                found += self._known(self.units, "", [first])
                found += self._known(self.spaced, " ", rest)
                before = " " + rest[-1] if rest else first
            elif part:
                own = self._split(part)
                found += self._known(self.units, "", own)
                before = own[-1]
        return found

    def _split(self, part: str) -> list[str]:
        return (self.rare_unit if _RARE.search(part) else _UNIT).findall(part)

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Exact counts of all prefixes that end between characters, as runs: ``firsts, ends, counts``.

        The prefixes of ``firsts[i]`` to ``ends[i]`` bytes have ``counts[i]`` tokens each.
        """
        found = self.parts_of(text)
        runs = np.frombuffer(b"".join(found), np.int32).reshape(-1, 3).astype(np.int64)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // RUN
        sizes = sizes[sizes > 0]
        # The last run of a unit has its bytes and tokens.
        whole = runs[np.cumsum(sizes) - 1, 1:]
        moved = np.repeat(np.cumsum(whole, axis=0) - whole, sizes, axis=0)
        return runs[:, 0] + moved[:, 0], runs[:, 1] + moved[:, 0], runs[:, 2] + moved[:, 1]

    def count(self, text: str) -> int:
        """Tokens of a text."""
        counts = self.table(text)[2]
        return int(counts[-1]) if len(counts) else 0

    def cut(self, text: str, budget: int) -> int:
        """Bytes of the longest prefix, cut between characters, that has at most ``budget`` tokens."""
        return within(self.table(text), budget)


def _runs(lengths: Sequence[int], counts: list[int]) -> bytes:
    """Runs of equal counts, without the empty prefix."""
    out: list[int] = []
    held = None
    for n, c in zip(lengths[1:], counts[1:], strict=True):
        if c == held:
            out[-2] = n
        else:
            out += (n, n, c)
            held = c
    return array("i", out).tobytes()


def _chained(parts: list[bytes]) -> bytes:
    """Runs of parts that follow one another; a further part has a token more, so no run goes on in it."""
    if len(parts) < 2:
        return parts[0] if parts else b""
    out = array("i", parts[0])
    for part in parts[1:]:
        size, total = out[-2], out[-1]
        if len(part) == RUN:
            first, end, count = array("i", part)
            out.extend((first + size, end + size, count + total))
            continue
        own = array("i", part)
        for i in range(0, len(own), 3):
            own[i] += size
            own[i + 1] += size
            own[i + 2] += total
        out += own
    return out.tobytes()


def within(table: tuple[np.ndarray, np.ndarray, np.ndarray], budget: int) -> int:
    """Bytes of the longest prefix of at most ``budget`` tokens; a longer prefix may need fewer tokens."""
    _, ends, counts = table
    fits = np.flatnonzero(counts <= budget)
    return int(ends[fits[-1]]) if len(fits) else 0


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One counter for each worker and file."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str, budgets: Sequence[int] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` and, for each budget b, ``cut_b``: the bytes that hold b tokens.

    ``path`` is the tokenizer's file on every executor.  A null or empty text has 0 bytes and 0
    tokens; special strings inside a text count as one token; rows that repeat give a row each;
    other columns of ``docs`` are not read.
    """
    budgets = tuple(budgets)

    def compute(texts: list[bytes | None]) -> list:
        own = counter(path)
        sizes = [len(t or b"") for t in texts]
        counts: list[int] = []
        cuts: list[list[int]] = [[] for _ in budgets]
        for t, size in zip(texts, sizes, strict=True):
            table = own.table((t or b"").decode("utf-8", "replace"))
            counts.append(int(table[2][-1]) if size else 0)
            for found, b in zip(cuts, budgets, strict=True):
                found.append(size if counts[-1] <= b else within(table, b))
        return [sizes, counts, *cuts]

    more = "".join(f", cut_{b} bigint" for b in budgets)
    return map_texts(id_and_text(docs), compute, f"n_bytes bigint, n_tokens bigint{more}")


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, firsts, ends, counts``: the exact tokens of every prefix that ends between characters.

    Prefixes of ``firsts[i]`` to ``ends[i]`` bytes have ``counts[i]`` tokens.  Stored once, it answers
    any later question by look-up (:func:`tokens_within`, :func:`units_within`).  A null or empty text
    has empty arrays.
    """

    def compute(texts: list[bytes | None]) -> list:
        own = counter(path)
        return list(zip(*[own.table((t or b"").decode("utf-8", "replace")) for t in texts], strict=True))

    return map_texts(id_and_text(docs), compute, "firsts array<bigint>, ends array<bigint>, counts array<bigint>")


def tokens_within(n_bytes):
    """Column: tokens of the longest prefix of at most ``n_bytes`` bytes that ends between characters."""
    at = F.size(F.filter("firsts", lambda e: e <= n_bytes))
    return F.when(at == 0, 0).otherwise(F.element_at("counts", F.greatest(at, F.lit(1)))).cast("long")


def units_within(budget: int):
    """Column: bytes of the longest prefix of at most ``budget`` tokens that ends between characters."""
    fits = F.zip_with("ends", "counts", lambda e, c: F.when(c <= budget, e))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("long")
