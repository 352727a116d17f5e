"""Word shingles of whole texts: numpy over the bytes of an Arrow column.

A word is a run of bytes other than the blank and 0x09-0x0D, with A-Z lower-cased. Every word and every shingle becomes a
64-bit hash; a document's set is the sorted array of its distinct shingle hashes. Memory follows the slice of rows that is
processed at once (``SLICE_BYTES`` of text, or one longer document), never the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
SLICE_BYTES = 1 << 21
LONG_WORD = 256
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the index of the first word of each row (with the end)."""
    if len(raw) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = raw + ((raw - np.uint8(65) < 26).astype(np.uint8) << 5)
    solid = (low != 32) & (low - np.uint8(9) > 4)
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(raw), bool)
    before[0], before[1:] = True, ~solid[:-1]
    starts = np.flatnonzero(solid & (before | cut[:-1]))
    after = np.empty(len(raw), bool)
    after[-1], after[:-1] = True, ~solid[1:]
    lengths = np.flatnonzero(solid & (after | cut[1:])) + 1 - starts
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(low),), "<u8", buffer=padded.data, strides=(1,))
    acc = lengths.astype(np.uint64) * _M1
    rest, at, left = np.arange(len(starts)), starts, lengths
    for _ in range(LONG_WORD // 8):
        if len(rest) == 0:
            break
        part = lanes[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        acc[rest] = mix(acc[rest] ^ part) + _M1
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    for i in rest:  # longer than LONG_WORD
        word = low[starts[i]:starts[i] + lengths[i]].tobytes()
        acc[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return acc, np.searchsorted(starts, offsets).astype(np.int64)


def shingle_runs(words: np.ndarray, first: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``size`` words in order, and the first window of each row.

    A row with fewer words has one window, all its words; one without words has none.
    """
    counts = np.diff(first)
    per_row = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    firsts = np.concatenate([[0], np.cumsum(per_row)])
    out = np.zeros(int(firsts[-1]), np.uint64)
    if len(out) == 0:
        return out, firsts
    full = len(words) - size + 1
    if full > 0:
        acc = np.full(full, np.uint64(size)) * _M1
        for j in range(size):
            acc = (acc ^ words[j:j + full]) * _M2
            acc ^= acc >> np.uint64(29)
        acc = mix(acc)
        row = np.repeat(np.arange(len(counts)), per_row)
        source = first[row] + np.arange(len(out)) - firsts[row]
        whole = counts[row] >= size
        out[whole] = acc[source[whole]]
    for r in np.flatnonzero((counts > 0) & (counts < size)):
        joined = words[first[r]:first[r + 1]].tobytes()
        out[firsts[r]] = int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "little")
    return out, firsts


def shingle_sets(column: pa.Array, size: int = WORDS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and the sorted distinct shingle hashes of each row, slice by slice."""
    raw, offsets = utf8(column)
    for a, b in slices(offsets):
        off = offsets[a:b + 1]
        words, first = word_hashes(raw[off[0]:off[-1]], off - off[0])
        runs, firsts = shingle_runs(words, first, size)
        sets = []
        for r in range(b - a):
            own = np.sort(runs[firsts[r]:firsts[r + 1]])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) > 1 else own)
        yield a, sets


def signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share and different sets do not (two sums of mixed hashes)."""
    one = int(mix(own ^ _M1).sum(dtype=np.uint64))
    two = int(mix(own + _M3).sum(dtype=np.uint64))
    return one - (1 << 64) * (one >> 63), two - (1 << 64) * (two >> 63)
