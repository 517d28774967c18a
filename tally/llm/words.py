"""Words of whole texts as 64-bit hashes, computed for an Arrow batch at a time.

A word is a maximal run of bytes other than the space and the bytes 9 to 13.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_CHUNK_BYTES = 1 << 21
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=U64)
_M1, _M2, _M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * _M2
    x = (x ^ (x >> U64(27))) * _M3
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of consecutive texts: text ``t`` has the words ``first[t]`` to ``first[t + 1]``."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray  # byte positions in ``data``
    end: np.ndarray
    data: np.ndarray
    rows: slice  # of the batch


def _hashed(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash byte ranges, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    value = mixed(size.astype(U64) * _M1)
    left, at, who = size, start, None
    while len(at):
        bits = eights[at] & _MASK[np.minimum(left, 8)]
        if who is None:
            value = mixed(value ^ bits)
            who = np.flatnonzero(left > 8)
        else:
            value[who] = mixed(value[who] ^ bits)
            who = who[left > 8]
        at, left = start[who] + (size[who] - (left[left > 8])) + 8, left[left > 8] - 8
    return value


def words_of(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of the texts of a batch, a few megabytes of text at a time; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    count = len(texts)
    if not count:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + count + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    whole = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < count:
        until = int(np.searchsorted(offsets, offsets[row] + _CHUNK_BYTES, side="right")) - 1
        until = min(max(until, row + 1), count)
        data = whole[offsets[row] : offsets[until]]
        if lower:
            data = _LOWER[data]
        bounds = offsets[row : until + 1] - offsets[row]
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[bounds] = True
        before = np.empty(len(data), dtype=bool)
        if len(data):
            before[0], before[1:] = False, word[:-1]
        start = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.empty(len(data), dtype=bool)
        if len(data):
            after[-1], after[:-1] = False, word[1:]
        end = np.flatnonzero(word & (~after | edge[1:])) + 1
        yield Words(
            _hashed(data, start, end - start),
            np.searchsorted(start, bounds),
            start,
            end,
            data,
            slice(row, until),
        )
        row = until


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of equally long sequences, given as one array for each place."""
    value = np.full(len(parts[0]), _M1, dtype=U64)
    for part in parts:
        value = mixed(value * _M3 + part)
    return value


def shingles(word: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashed shingles, sorted; the whole sequence where there are fewer words."""
    if not len(word):
        return word
    if len(word) < size:
        return chained([word[i : i + 1] for i in range(len(word))] + [np.array([len(word)], U64)])
    return np.unique(chained([word[i : len(word) - size + 1 + i] for i in range(size)]))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
