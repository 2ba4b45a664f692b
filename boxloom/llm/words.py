"""Words, five-word shingles and 64-bit hashes of whole texts, in numpy over batches.

Words are maximal runs of bytes other than space and ``\\x09-\\x0D``, with ``A-Z`` lower-cased. On
UTF-8 bytes that is what ``bytes.lower().split()`` does.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_HALF = np.uint64(33)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> _HALF)) * _MIX1
    x = (x ^ (x >> _HALF)) * _MIX2
    return x ^ (x >> _HALF)


class WordHashes(dict):
    """word -> 64-bit hash. Once ``limit`` words are held, further words are hashed each time."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def hash(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)

    def __missing__(self, word: bytes) -> int:
        value = self.hash(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the shingles in text order; with fewer words, of the whole sequence."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    last = n - width + 1
    out = words[:last] + np.uint64(width)
    for k in range(1, width):
        out = out * _PRIME + words[k : k + last]
    return mix64(out)


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles, sorted."""
    return np.unique(shingles(words, width))


def batches(items, weight, limit: int):
    """Cut a sequence into lists whose summed ``weight`` stays near ``limit``."""
    held, total = [], 0
    for x in items:
        held.append(x)
        total += weight(x)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held
