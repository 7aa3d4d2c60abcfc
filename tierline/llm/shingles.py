"""Words and word shingles of texts as 64-bit hashes, for Python workers."""

from __future__ import annotations

import numpy as np
import xxhash

# Entries of a worker's word cache before it starts anew.
CACHE = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hashes of words, kept while the cache is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between white space (space and U+0009 to U+000D), with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """The hashes with all bits depending on all bits."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, size: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one shingle, no word none."""
    words = cache.of(words_of(text))
    if not len(words):
        return words
    width = min(size, len(words))
    h = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        h = h * _STEP + mixed(words[i : i + len(h)])
    return np.unique(mixed(h))
