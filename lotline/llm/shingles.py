"""Word shingles of texts as sets of 64-bit numbers."""

from __future__ import annotations

import sys
from hashlib import blake2b

import numpy as np
from pyspark import cloudpickle

from lotline.llm.common import worker_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of the dictionary of a worker; a full one starts anew.
MEMO_WORDS = 300_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text: A-Z lower-cased, cut at ASCII white space."""
    return text.translate(_LOWER).split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Words to 64-bit numbers, kept in a bounded dictionary, and word lists to shingle sets."""

    def __init__(self, width: int):
        self.width = width
        self.numbers: dict[bytes, int] = {}

    def set_of(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct shingle numbers; a shorter list is one shingle, an empty one none."""
        if not words:
            return np.zeros(0, np.uint64)
        known = self.numbers
        if len(known) > MEMO_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        numbers = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        value = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
        for j in range(width):
            value = mixed(value * _ODD + numbers[j : j + len(value)])
        return np.unique(value)


def name_of(words: list[bytes]) -> bytes:
    """128 bits that stand for a word sequence."""
    return blake2b(b" ".join(words), digest_size=16).digest()


def shingler(width: int) -> Shingler:
    """The worker's shingler."""
    known = worker_store(f"shingler-{width}")
    return known.get(0) or known.setdefault(0, Shingler(width))
