"""Words of many texts at once, hashed with numpy over the bytes of an Arrow column.

Words are separated by ASCII white space and A-Z count as a-z, so both can be seen in UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_rng = np.random.Generator(np.random.PCG64(7))
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result depends on all bits of ``h``."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)``: runs of whole texts of about ``most`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and each text's place in them (one more than there are texts)."""
    return hashed_words(data, offsets, between)[:2]


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, each text's place in them (one more than there are texts), and words' last bytes.

    ``between`` says which bytes stand between words.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.uint8)
    inside = ~between[data]
    # A word ends where its text ends, too.
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    # A polynomial over the word's bytes, from running sums; unsigned numbers wrap around.
    powers = np.full(len(data), _B)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * powers, out=sums[1:])
    del powers
    inverse = np.full(len(data), _B_INV)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    h = (sums[ends] - sums[starts]) * inverse[starts]
    hashes = mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return hashes, np.searchsorted(starts, offsets), data[ends - 1]
