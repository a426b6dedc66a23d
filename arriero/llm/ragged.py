"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words and shingles of many rows at once.

Rows are handled in chunks of bounded bytes, so memory follows the chunk (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10

_rng = np.random.default_rng(20240607)
_BYTE_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_powers = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base (or of its inverse modulo 2^64); kept for the next chunk."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 64)
        have = np.full(size, _BASE_INVERSE if inverse else _BASE, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:
            _powers[inverse] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows one after the other, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    column = pc.fill_null(column, b"") if column.null_count else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]: at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of at most ``limit`` bytes, at least one row each."""
    data, offsets = utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words (runs without blank, tab to carriage return) and each row's first word, n + 1 long."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes; a span's hash is ``span_hash``."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers(len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words, A-Z lower-cased, and each row's first word."""
    starts, ends, first = word_spans(data, offsets)
    return span_hash(prefix_sums(LOWER[data]), starts, ends), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Each row's set of shingles as sorted distinct 64-bit hashes; fewer words than ``width``: all words as one shingle."""
    words, first = word_hashes(data, offsets)
    n = len(words)
    rolled = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        rolled *= _SHINGLE_BASE
        rolled += words[k: k + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            one = np.sort(rolled[a: b - width + 1])
            out.append(one[np.concatenate(([True], one[1:] != one[:-1]))])
        elif b > a:
            h = np.uint64(b - a)
            for w in words[a:b].tolist():
                h = np.uint64((int(h) * int(_SHINGLE_BASE) + w) & 0xFFFFFFFFFFFFFFFF)
            out.append(mixed(np.array([h], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
