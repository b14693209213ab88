"""Sets of word shingles as sorted 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Words:
    """Hashes of words. Nothing is kept from text to text: a table of known words would grow with the vocabulary, and looking
    a word up in a large one takes longer than hashing it."""

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, known: Words, every_letter: bool = False) -> np.ndarray:
    """Hashes of the words of a text, with A-Z (or every letter) lower-cased; words end at the six ASCII white-space
    characters."""
    text = text or ""
    return known.of((text.lower() if every_letter else text).encode("utf-8", "replace").lower().split())


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One number per run of ``width`` words, in order; with fewer words, one for the whole sequence."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(width, n)
    with np.errstate(over="ignore"):
        h = np.full(n - width + 1, np.uint64(width), np.uint64)
        for i in range(width):
            h = mixed(h * _A + words[i:n - width + 1 + i])
    return h
