"""Words of many texts at once: places and 64-bit hashes, computed with numpy over one buffer."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
#: Bytes that end a word of ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Byte ranges are hashed as polynomials modulo this prime; without a prime, powers of the ratio have a
#: structure by which different texts (letters by doubling and exchange) get one value whatever the ratio.
PRIME = (1 << 61) - 1
_RATIO = 0x1B8735939E3779B9  # below the prime
_INVERSE = pow(_RATIO, -1, PRIME)
_P, _HALF = U64(PRIME), U64((1 << 31) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xC2B2AE3D27D4EB4F)
    h ^= h >> U64(32)
    return h


def reduced(x: np.ndarray) -> np.ndarray:
    """Any words modulo the prime."""
    x = (x & _P) + (x >> U64(61))
    return np.where(x >= _P, x - _P, x)


def times_half(x: np.ndarray) -> np.ndarray:
    """x * 2**31 modulo the prime, for x below it; not reduced."""
    return ((x & U64((1 << 30) - 1)) << U64(31)) + (x >> U64(30))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, of numbers below it."""
    a_high, a_low, b_high, b_low = a >> U64(31), a & _HALF, b >> U64(31), b & _HALF
    middle = a_high * b_low + a_low * b_high
    return reduced(U64(2) * (a_high * b_high) + reduced(a_low * b_low) + times_half(reduced(middle)))


@lru_cache(maxsize=4)
def _powers(n: int, ratio: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = times(out[:more], np.full(more, pow(ratio, done, PRIME), np.uint64))
        done += more
    return out


def powers(n: int, ratio: int = _RATIO) -> np.ndarray:
    size = 1 << max(12, (n - 1).bit_length())
    return _powers(size, ratio)[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomials of all prefixes modulo the prime, one more than there are bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    step = 1 << 22  # sums of so many halves stay in a word
    for begin in range(0, len(data), step):
        power = powers(len(data))[begin:begin + step]
        letter = data[begin:begin + step].astype(np.uint64) + U64(1)
        high = reduced(np.cumsum(letter * (power >> U64(31)), dtype=np.uint64))
        low = reduced(np.cumsum(letter * (power & _HALF), dtype=np.uint64))
        out[begin + 1:begin + 1 + len(power)] = reduced(times_half(high) + low + out[begin])
    return out


class Words:
    """Words of a list of texts.

    ``data`` holds the texts, a space after each; text i is ``data[offsets[i]:offsets[i + 1] - 1]``.
    ``starts`` and ``ends`` are the words' places in it, ``first`` the first word of each text
    (one longer than the list).
    """

    def __init__(self, texts: list[bytes | None], table: bytes | None = None, breaks: np.ndarray = SPACES) -> None:
        whole = b" ".join([t or b"" for t in texts] + [b""])
        if table is not None:
            whole = whole.translate(table)
        self.whole = whole
        self._sums: np.ndarray | None = None
        self.data = np.frombuffer(whole, np.uint8)
        self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t or b"") + 1 for t in texts], out=self.offsets[1:])
        inside = np.concatenate([[False], ~breaks[self.data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return self.hash_of(self.starts, self.ends)

    def hash_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of any byte ranges; equal bytes have equal hashes."""
        if self._sums is None:
            self._sums = prefix_sums(self.data)
        inside = reduced(self._sums[ends] + _P - self._sums[starts])
        h = times(inside, powers(len(self.data) + 1, _INVERSE)[starts])
        return mix(h + (ends - starts).astype(np.uint64) * U64(0x9E3779B97F4A7C15))


def windows(hashes: np.ndarray, size: int, ratio: int = 0xA0761D6478BD642F) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values, by doubling; shorter than the input by size - 1."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    block, length = hashes, 1  # block[i] covers hashes[i:i + length]
    out, done = None, 0
    rest = size
    while rest:
        if rest & 1:
            scale = U64(pow(ratio, done, 1 << 64))
            part = block[done:done + n] * scale
            out = part if out is None else out + part
            done += length
        rest >>= 1
        if rest:
            block = block[: len(block) - length] + block[length:] * U64(pow(ratio, length, 1 << 64))
            length *= 2
    return mix(out)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in ``[s, s + size)`` for a start s."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n), -1)
    return np.cumsum(steps[:n]) > 0
