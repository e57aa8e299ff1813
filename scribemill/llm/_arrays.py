"""Numpy and Arrow helpers that the operators run inside Spark tasks: whole batches of texts as one byte array."""

from __future__ import annotations

import ctypes
import functools
import inspect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes of words split at white space
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
#: bytes of words of ASCII digits and letters and of all other characters
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, null as empty, and the n + 1 offsets between them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2] if len(column) else None
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow binary values over consecutive byte ranges."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; none crosses a text's end."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts as one Arrow array, and the n + 1 word offsets of the texts."""
    mask = inside[data]
    starts, ends = runs(mask, offsets)
    kept = data[mask]
    ends_at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=ends_at[1:])
    return binary(LOWER[kept] if lower else kept, ends_at), np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(8)
def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64)))


_tables: dict[int, np.ndarray] = {}
#: tables of more entries than this, and what groups of more bytes leave behind, are not kept
KEPT_POWERS, LARGE_GROUP = 1 << 18, 4 << 20


@functools.lru_cache(1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # a C library without it
        return None


def release() -> None:
    """Give memory that is free within this process back to the system: Python workers outlive their tasks."""
    for base in [b for b, x in _tables.items() if len(x) > KEPT_POWERS]:
        del _tables[base]
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def tidy(f):
    """f, for mapInArrow or applyInArrow, that releases memory when a task or a large group is over."""
    if inspect.isgeneratorfunction(f):

        def run(batches):
            try:
                yield from f(batches)
            finally:
                release()

    elif len(inspect.signature(f).parameters) == 1:

        def run(table):
            out = f(table)
            if table.nbytes > LARGE_GROUP:
                release()
            return out

    else:

        def run(left, right):
            out = f(left, right)
            if left.nbytes + right.nbytes > LARGE_GROUP:
                release()
            return out

    return run


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base^0 ... base^(n - 1) modulo 2^64; one table a base, as long as needed so far."""
    if len(_tables.get(base, ())) < n:
        out = np.full(1 << max(16, (int(n) - 1).bit_length()), base, dtype=np.uint64)
        out[0] = 1
        np.cumprod(out, out=out)
        _tables[base] = out
    return _tables[base][:n]


def prefix_hashes(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """H with H[j] - H[i] = sum of value(byte t) * BASE^t over i <= t < j, modulo 2^64."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.take(byte_values(seed), data, out=out[1:])
    out[1:] *= powers(len(data))
    np.cumsum(out[1:], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte ranges, alike wherever the bytes stand."""
    return (prefix[ends] - prefix[starts]) * powers(len(prefix), INVERSE)[starts]


def hash_binary(values: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of Arrow binary values."""
    data, offsets = texts(values)
    length = (offsets[1:] - offsets[:-1]).astype(np.uint64)
    return mix(range_hashes(prefix_hashes(data, seed), offsets[:-1], offsets[1:]) + length * np.uint64(0xC2B2AE3D27D4EB4F))


def coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes and the distinct values they stand for."""
    found = values.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def sliced(offsets: np.ndarray, most: int):
    """Ranges of consecutive texts of at most so many bytes together, or one text each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)


def shard_runs(keys: np.ndarray, n_shards: int, bits: int = 64) -> list[tuple[int, int, int]]:
    """(shard, start, end) of ascending keys of so many bits, for the shards that have any: ranges of equal width. The
    work and the runs are at most as many as the keys, whatever the number of shards."""
    if not len(keys):
        return []
    shard = ((keys >> np.uint64(bits - 32)) * np.uint64(n_shards)) >> np.uint64(32)
    starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return list(zip(shard[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True))
