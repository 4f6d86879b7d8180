"""Hashed word shingles of whole texts, one numpy pass per document."""

from __future__ import annotations

import numpy as np
import xxhash

_MASK = (1 << 64) - 1
#: Odd constants (64 bits), one per place in a shingle, from the golden ratio.
_ODD = [(0x9E3779B97F4A7C15 * (2 * i + 1) | 1) & _MASK for i in range(64)]
#: Word hashes kept by a worker.
_KEPT = 1_000_000


class WordHashes(dict):
    """64-bit hash of a word (bytes); at most ``kept`` are kept between documents."""

    def __init__(self, kept: int = _KEPT):
        super().__init__()
        self.kept = kept

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.kept:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


def ordered_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words."""
    n = len(words) - k + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total += mixed(words[i : i + n] ^ np.uint64(_ODD[i])) * np.uint64(_ODD[i + 1])
    return mixed(total)


def shingle_set(text: str | None, k: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a text of fewer words is one shingle, one without words none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return np.unique(ordered_hash(h, min(k, len(words))) + np.uint64(min(k, len(words))))
