"""Vectorised word and shingle hashing of UTF-8 texts.

Words are runs of bytes other than space and \\t..\\r, with A-Z lower-cased. A word's hash is a
polynomial over its bytes modulo 2**64 with a random value per byte, then mixed.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so invertible modulo 2**64
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Byte classes of plain words.
WORD = np.ones(256, np.uint8)
WORD[[32, 9, 10, 11, 12, 13]] = 0
ALONE = 3
#: Letters and digits only.
PLAIN = np.zeros(256, np.uint8)
PLAIN[list(b"abcdefghijklmnopqrstuvwxyz0123456789") + list(range(128, 256))] = 1
#: Runs of letters, runs of other signs, single digits.
RUNS = WORD * 2
RUNS[list(b"abcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = 1
RUNS[list(b"0123456789")] = ALONE


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 1 << 19)
        up, down = np.full(size, _BASE), np.full(size, _INV)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """H with ``(H[b] - H[a]) * inverse[a]`` the polynomial of ``buf[a:b]``."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUE[buf] * up[: len(buf)], out=out[1:])
    return out


class Words:
    """Words of several texts.

    ``first`` holds the index of each text's first word (one more entry than texts);
    ``start``/``end`` are byte offsets into ``buf``, ``base`` where each text begins in it.
    """

    def __init__(self, texts: list[bytes], kinds: np.ndarray = WORD, latin: bool = False):
        """``kinds`` gives each byte's class: 0 between words, ``ALONE`` a word by itself;
        neighbouring bytes of two classes also belong to two words. ``latin`` also lower-cases
        U+00C0 to U+00DE."""
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.base = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.buf = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)] if texts else np.zeros(0, np.uint8)
        if latin and len(self.buf):
            capital = (self.buf[:-1] == 0xC3) & (self.buf[1:] >= 0x80) & (self.buf[1:] <= 0x9E) & (self.buf[1:] != 0x97)
            self.buf[1:][capital] += 32
        kind = kinds[self.buf]
        before = np.concatenate([[0], kind[:-1]]).astype(np.uint8) if texts else kind
        begins = (kind != 0) & ((kind != before) | (kind == ALONE))
        edge = np.flatnonzero(begins | ((kind == 0) & (before != 0)))
        opens = np.flatnonzero(begins[edge])
        self.start, self.end = edge[opens], edge[opens + 1]
        self._total = prefix_hash(self.buf)
        self.hash = self._span_hash(self.start, self.end)
        self.first = np.searchsorted(self.start, self.base)

    def _span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inverse = powers(len(self.buf))
        return mix((self._total[end] - self._total[start]) * inverse[start] + (end - start).astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(indices of words longer than ``n`` bytes, hashes of their first ``n`` bytes)."""
        long = np.flatnonzero(self.end - self.start > n)
        return long, self._span_hash(self.start[long], self.start[long] + n) + np.uint64(n)

    def shingles(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on; only those within one text are meaningful."""
        h, size = self.hash, len(self.hash)
        out = np.zeros(size, np.uint64)
        for j in range(n):
            out[: size - j] = mix(out[: size - j] + h[j:] * np.uint64(2 * j + 3))
        return out

    def shingle_sets(self, n: int) -> list[np.ndarray]:
        """Sorted distinct n-word shingles of each text; a shorter text is one shingle, an empty one has none."""
        grams, sets = self.shingles(n), []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= n:
                sets.append(np.unique(grams[a : b - n + 1]))
            elif b > a:
                whole = np.zeros(1, np.uint64)
                for j in range(a, b):
                    whole = mix(whole + self.hash[j : j + 1] * np.uint64(2 * (j - a) + 3))
                sets.append(whole + np.uint64(b - a))  # never meets a shingle of n words
            else:
                sets.append(np.zeros(0, np.uint64))
        return sets
