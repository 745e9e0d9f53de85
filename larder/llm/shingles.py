"""Hashes of word windows, computed for whole batches of texts at once."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np

#: Odd, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


CODES = mix(np.arange(1, 257, dtype=np.uint64))


#: Bytes hashed at once, and the length from which a word is hashed on its own.
STRETCH, LONG_WORD = 1 << 20, 1 << 16


class Powers:
    """Powers of ``BASE`` and of its inverse, kept up to the largest number asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", INVERSE)):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))


class Windows:
    """Word windows of a batch of texts.

    ``words`` counts each text's words, ``first`` is the number of its first word in the batch, ``joined`` holds all words, joined by
    single spaces, word ``i`` from ``starts[i]`` to ``ends[i]``. Memory beyond the words themselves is some 40 bytes a word.
    """

    def __init__(self, texts: Sequence[bytes], powers: Powers):
        split = [t.split() for t in texts]
        self.words = np.array([len(ws) for ws in split], dtype=np.int64)
        self.first = np.append(0, np.cumsum(self.words))
        self.joined = b" ".join([b" ".join(ws) for ws in split if ws])
        del split
        raw = np.frombuffer(self.joined, np.uint8)
        self.ends = np.append(np.flatnonzero(raw == 32), len(raw)) if len(raw) else np.zeros(0, np.int64)
        self.starts = np.append(0, self.ends[:-1] + 1) if len(raw) else np.zeros(0, np.int64)
        powers.upto(max(STRETCH + LONG_WORD, len(self.starts)) + 1)
        self.powers = powers
        terms = self.word_hashes(raw) * powers.up[: len(self.starts)]
        self.sums = np.append(np.uint64(0), np.cumsum(terms, dtype=np.uint64))

    def word_hashes(self, raw: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        lengths = self.ends - self.starts
        long = np.flatnonzero(lengths > LONG_WORD)
        at = 0
        while at < len(out):
            if lengths[at] > LONG_WORD:
                word = hashlib.blake2b(raw[self.starts[at] : self.ends[at]], digest_size=8).digest()
                out[at], at = int.from_bytes(word, "little"), at + 1
                continue
            base = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, base + STRETCH, "right")))
            to = min(to, int(long[np.searchsorted(long, at)])) if np.searchsorted(long, at) < len(long) else to
            a, b = self.starts[at:to] - base, self.ends[at:to] - base
            part = raw[base : self.ends[to - 1]]
            sums = np.append(np.uint64(0), np.cumsum(CODES[part] * self.powers.up[: len(part)], dtype=np.uint64))
            out[at:to] = mix((sums[b] - sums[a]) * self.powers.down[a] + (b - a).astype(np.uint64))
            at = to
        return out

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """64-bit hashes of the word sequences from ``first`` to ``last``, both inclusive."""
        return mix((self.sums[last + 1] - self.sums[first]) * self.powers.down[first] + (last - first + 1).astype(np.uint64))

    def sets(self, size: int) -> list[np.ndarray]:
        """Of each text the sorted distinct hashes of its windows of ``size`` words; of a shorter text its one whole sequence."""
        out = []
        for n, at in zip(self.words.tolist(), self.first.tolist(), strict=False):
            if n:
                first = np.arange(at, at + max(1, n - size + 1))
                out.append(np.unique(self.hashes(first, np.minimum(first + size - 1, at + n - 1))))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def blocks(values: Sequence[bytes | None], limit: int = 4_000_000):
    """Cut a batch of texts into (first, last) blocks of about ``limit`` bytes; nulls count as empty."""
    at = total = 0
    for i, value in enumerate(values):
        total += len(value or b"")
        if total >= limit:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(values):
        yield at, len(values)


def text_blocks(column, limit: int, rows: int = 512):
    """(first row, texts) of blocks of an Arrow column, of about ``limit`` bytes and at most ``rows`` rows, so that only these are Python values."""
    for first in range(0, len(column), rows):
        texts = column.slice(first, rows).to_pylist()
        for a, b in blocks(texts, limit):
            yield first + a, texts[a:b]
