"""Vectorised word, hash and shingle work on the byte buffers of Arrow string columns.

All word rules used here separate at ASCII bytes only, so UTF-8 bytes can be classified
one by one and no Python string is ever built. A batch is worked off in runs of rows of
about `CHUNK` bytes, which bounds the temporary arrays; one longer text is a run of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A fixed 64-bit value for every byte.
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words: digits, letters and all bytes of non-ASCII characters (after lower-casing).
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
#: Bytes of words: everything but ASCII white space.
SPACED_WORD = np.ones(256, bool)
SPACED_WORD[[0x20, *range(0x09, 0x0E)]] = False

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every pair, from one running sum."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying its text; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    offs = offs.astype(np.int64)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def runs(column: pa.Array, limit: int = CHUNK, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of up to `rows` consecutive rows of up to `limit` bytes."""
    data, offs = byte_view(column)
    row = 0
    while row < len(column):
        end = min(row + rows, max(row + 1, int(np.searchsorted(offs, offs[row] + limit, "right")) - 1))
        yield row, end, data[offs[row] : offs[end]], offs[row : end + 1] - offs[row]
        row = end


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in parts of some rows, which bounds what is held and handed on at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


def release() -> None:
    """Give memory that is free in this worker back: it stays alive, idle, while Spark sorts and joins."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def text_array(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def word_spans(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per text the index of its first word (with an end mark)."""
    n = len(data)
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offs[:-1][offs[:-1] < n]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words after lower-casing A-Z, and the word bounds of every text."""
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, offs, table)
    return range_hashes(BYTE_VALUES[data], starts, ends), bounds


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (also across texts: the caller cuts at the bounds)."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    at = np.arange(len(words) - k + 1)
    return range_hashes(words, at, at + k)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingle hashes of every text; a text of fewer words is one shingle."""
    for _, _, data, offs in runs(column):
        words, bounds = word_hashes(data, offs, SPACED_WORD)
        grams = gram_hashes(words, k)
        n = np.diff(bounds)
        short = np.flatnonzero((n > 0) & (n < k))
        whole = dict(zip(short.tolist(), range_hashes(words, bounds[short], bounds[short + 1]).tolist(), strict=True)) if len(short) else {}
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b - a >= k:
                yield np.unique(grams[a : b - k + 1])
            elif b > a:
                yield np.array([whole[i]], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def list_column(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.Array:
    """A list column of arrays; unsigned 64-bit hashes are passed as the signed values of the same bits."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
