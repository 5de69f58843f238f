"""Word shingles as multisets of 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words in a shingle.
WIDTH = 5

#: Distinct words whose hashes a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits, with good avalanche."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, known: WordHashes, width: int = WIDTH) -> np.ndarray:
    """A hash for every run of ``width`` lower-case words between white space; a shorter text is one run; no words, no runs."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out = out * _MULTIPLIER + h[i : len(words) - width + 1 + i]
    return mix(out)


def multiset(text: str, known: WordHashes, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles and their counts."""
    return np.unique(shingles(text, known, width), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of smaller counts over the sum of larger ones; 1 for two empty multisets."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    shared = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return shared / (total - shared)
