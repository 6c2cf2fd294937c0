"""Whole texts of Arrow batches as byte arrays: blocks, words and hashes.

A batch is worked through in blocks of about a megabyte, so memory follows the block and
the longest single text, not the batch. Texts are never cut. A null text is an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

# White space that ends a word, and its pattern.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
WORD = re.compile(r"[^\x20\x09-\x0D]+")

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


IS_SPACE = byte_table(SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and the offsets of the texts in it."""
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.combine_chunks()
    strings = pc.fill_null(strings.cast(pa.large_string()), "")
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def text_blocks(strings: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of each block of whole texts."""
    if not len(strings):
        return
    data, at = text_bytes(strings)
    first = 0
    while first < len(strings):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
        powers = np.ones(size, np.uint64)
        done, step = 1, base
        while done < size:
            more = min(done, size - done)
            powers[done : done + more] = powers[:more] * np.uint64(step)
            done += more
            step = step * step & _MASK
        found.append(powers)
    return found[0], found[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash multiplier and of its inverse, at least ``size`` of each."""
    return _powers(max(1 << 21, 1 << (size - 1).bit_length() if size > 1 else 1))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block; no word crosses two texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~is_space[data]
    here = inside[1:-1]
    before, after = inside[:-2].copy(), inside[2:].copy()
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    before[bounds] = False
    after[bounds - 1] = False
    return np.flatnonzero(here & ~before), np.flatnonzero(here & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: equal spans have equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbours."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for k in range(width):
        found = found * np.uint64(_MULTIPLIER) + hashes[k : k + n]
    return mix(found)


def rows_of(counts: np.ndarray) -> np.ndarray:
    """The row number of each item, for so many items in each row."""
    return np.repeat(np.arange(len(counts)), counts)
