"""The binary Golay code of length 23 as a fuzzy hash: a word's key is the index of its nearest codeword.

The code is perfect: each of the 2**23 words lies within 3 bits of exactly one
of 4096 codewords. ``near_keys`` gives the keys of a word and of all words one
bit away. Two words at most two bits apart share one of them: a word between
them is one bit from both (or is one of them), and its codeword is in both sets.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

# The generator x^11+x^10+x^6+x^5+x^4+x^2+1 of the (23, 12) code.
GENERATOR = 0b110001110101
CHECK_BITS = 11


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of each 12-bit message; error pattern of each syndrome."""
    rest = np.arange(4096, dtype=np.int64) << CHECK_BITS
    for bit in range(22, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK_BITS)), rest)
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            e = sum(1 << p for p in places)
            errors[rest[e >> CHECK_BITS] ^ (e & 0x7FF)] = e
    return rest, errors


def key(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each word of up to 23 bits."""
    checks, errors = _tables()
    words = words.astype(np.int64)
    return (words ^ errors[checks[words >> CHECK_BITS] ^ (words & 0x7FF)]) >> CHECK_BITS


def near_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each word and its one-bit neighbours among ``bits`` bits, and which are first of their kind in a row."""
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.int64)
    keys = np.sort(key(words[:, None] ^ flips[None, :]), axis=1)
    first = np.ones(keys.shape, dtype=bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return keys, first
