"""Word shingle sets of whole texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hash a worker remembers at most; then its memory starts anew.
MAX_WORDS = 150_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


class WordHashes(dict):
    """Hash of a word, computed once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MAX_WORDS:
            self.clear()
        self[word] = value
        return value


WORDS = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(32))) * _C
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words of text, A-Z in lower case, words parted by space and U+0009 to U+000D.

    A text of fewer words is one shingle, its whole sequence; without words the set is empty.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    run = min(size, len(h))
    out = np.full(len(h) - run + 1, run, np.uint64)
    for k in range(run):
        out = mixed(out * _B + h[k : len(h) - run + 1 + k])
    return np.unique(out)
