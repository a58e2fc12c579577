"""Word shingles of whole texts as sorted sets of 64-bit hashes.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lowered.
Words get a polynomial hash from one running sum over the text's bytes; five
neighbouring word hashes are mixed into one shingle hash.  All steps are array
operations over the bytes of a text, or of a block of texts end to end.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from strata.llm.common import bytes_of

SIZE = 5
#: Bytes of texts taken end to end at once; a longer text is a block of its own.
TEXT_BLOCK = 1 << 18
BASE = 0x9E3779B97F4A7C15
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (wrapping arithmetic)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, modulo 2**64, for i below ``size`` (a power of two)."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p, step = np.ones(1, np.uint64), base
        while len(p) < size:
            p, step = np.concatenate([p, p * U(step)]), step * step % (1 << 64)
        out.append(p)
    return out[0], out[1]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def word_hashes(text: str) -> np.ndarray:
    """One hash per word, in order."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64)
    inside = IN_WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    if inside[-1]:
        edge = np.concatenate([edge, [n]])
    first, last = edge[::2], edge[1::2]
    power, inverse = powers(1 << max(16, int(n).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + U(1)) * power[:n], out=total[1:])
    return mix((total[last] - total[first]) * inverse[first] + (last - first).astype(np.uint64))


def shingle_set(text: str, size: int = SIZE) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle of all its words."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    total = np.full(n - width + 1, U(width))
    for i in range(width):
        total = mix(total * U(BASE) + words[i : n - width + 1 + i])
    return np.unique(total)


def _block_sets(data: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """``shingle_set`` of each text of a block, given its bytes and where texts begin and the last one ends."""
    inside = IN_WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = cuts[1:] > cuts[:-1]
    for marks, edge in ((begins, cuts[:-1][full]), (ends, cuts[1:][full] - 1)):  # no word leaves its text
        marks[edge] = inside[edge]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = powers(1 << max(16, len(data).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + U(1)) * power[: len(data)], out=total[1:])
    words = mix((total[last] - total[first]) * inverse[first] + (last - first).astype(np.uint64))
    at = np.searchsorted(first, cuts).tolist()
    runs = {}  # by width: texts of fewer words than SIZE have one shingle of all their words
    out = []
    for a, b in zip(at[:-1], at[1:]):
        width = min(SIZE, b - a)
        if not width:
            out.append(words[:0])
            continue
        if width not in runs:
            runs[width] = np.full(len(words) - width + 1, U(width))
            for i in range(width):
                runs[width] = mix(runs[width] * U(BASE) + words[i : len(words) - width + 1 + i])
        own = runs[width][a : b - width + 1]
        own.sort()
        again = own[1:] == own[:-1]
        out.append(own[np.append(True, ~again)] if again.any() else own)
    return out


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """``shingle_set`` of each text of a column."""
    data, cuts = bytes_of(texts)
    out, low = [], 0
    while low < len(cuts) - 1:
        high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + TEXT_BLOCK, "right")) - 1)
        out += _block_sets(data[cuts[low] : cuts[high]], cuts[low : high + 1] - cuts[low])
        low = high
    return out
