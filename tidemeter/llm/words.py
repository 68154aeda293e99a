"""Words and word runs of whole texts as 64-bit hashes, vectorised over a batch of texts.

Words are found on UTF-8 bytes: every byte of a character beyond ASCII belongs to a word, so a byte table
decides as a character class would. Hashes are 64 bits wide; two different words or runs that are compared
share one with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: `[^\x20\x09-\x0D]+`
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        x = x + U64((salt * BASE + BASE) % 2**64)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTES = mix(np.arange(256, dtype=U64), 7)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    up, down = np.full(size, U64(BASE)), np.full(size, U64(pow(BASE, -1, 2**64)))
    up[0] = down[0] = U64(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return at - at[0], data[at[0] : at[-1]]


def word_hashes(texts: pa.Array, kind: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of the batch: (first text, word offsets by text, word hashes), A-Z lower-cased."""
    at, data = utf8(texts)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, "right")) - 1)
        edges = at[first : last + 1] - at[first]
        yield first, *_words(edges, LOWER[data[at[first] : at[last]]], kind)
        first = last


def _words(edges: np.ndarray, data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(len(edges), dtype=np.int64), np.zeros(0, dtype=U64)
    inside = kind[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    cuts = edges[(edges > 0) & (edges < len(data))]
    before[cuts], after[cuts - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    up, down = _powers(max(SLICE_BYTES, 1 << (len(data)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, dtype=U64)
        sums[0] = 0
        np.cumsum(BYTES[data] * up[: len(data)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)
    return np.searchsorted(starts, edges), mix(hashes)


def runs(words: np.ndarray, size: int, salt: int = 1) -> np.ndarray:
    """Hashes of all runs of ``size`` words, over text borders too; callers leave those out."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=U64)
    factors = mix(np.arange(size, dtype=U64), 100 + salt) | U64(1)
    with np.errstate(over="ignore"):
        total = words[:count] * factors[0]
        for j in range(1, size):
            total = total + words[j : j + count] * factors[j]
    return mix(total, salt)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... (count of them) of each element, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return shift + np.arange(total)
