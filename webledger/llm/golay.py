"""The binary Golay code of length 23 as a fuzzy hash of 23-bit words.

The code is perfect: each word lies within three bits of exactly one of 4,096
codewords.  ``keys(x)`` names the codewords that x and its 23 one-bit
neighbours decode to; there are one or six of them.  Two words that differ in
two bits or fewer have a common neighbour, or are neighbours, and so share a
key.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

N, CHECK = 23, 11
#: Fixed value: a generator polynomial of the code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def remainder(x: int) -> int:
    for bit in range(N - 1, CHECK - 1, -1):
        if x >> bit & 1:
            x ^= GENERATOR << (bit - CHECK)
    return x


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; for each syndrome the
    error pattern, the changes of index that lead to its keys, and their number."""
    one = [remainder(1 << b) for b in range(N)]

    def linear(first: int, bits: int) -> np.ndarray:
        out = np.zeros(1 << bits, np.int64)
        for b in range(bits):
            out[1 << b : 2 << b] = out[: 1 << b] ^ one[first + b]
        return out

    leader = np.zeros(1 << CHECK, np.int64)
    weight = np.zeros(1 << CHECK, np.int64)
    for size in (1, 2, 3):
        for bits in combinations(range(N), size):
            s = 0
            for b in bits:
                s ^= one[b]
            leader[s], weight[s] = sum(1 << b for b in bits), size
    change = np.zeros((1 << CHECK, 6), np.int64)
    count = np.where(weight == 3, 6, 1)
    for s in np.flatnonzero(weight == 3):
        found = set()
        for b in range(N):
            if not leader[s] >> b & 1:
                # Four errors: the decoder takes them for another codeword's three.
                four = int(leader[s]) | 1 << b
                found.add((four ^ int(leader[s ^ one[b]])) >> CHECK)
        change[s, 1:] = sorted(found)
    return linear(0, 12), linear(12, 11), leader, change, count


def keys(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) codeword indices of n words and how many of each row are distinct (one or six, the first ones)."""
    low, high, leader, change, count = tables()
    s = low[x & 0xFFF] ^ high[x >> 12]
    return ((x ^ leader[s]) >> CHECK)[:, None] ^ change[s], count[s]
