"""Vectorised text primitives on Arrow string buffers: bytes are handled for a whole batch at once."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash

# Arrow's own allocator keeps what it has; the system's gives it back, see trim().
pa.set_memory_pool(pa.system_memory_pool())

#: ASCII white space, as in the class [\x20\x09-\x0D].
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SPACE_BYTES = b" \t\n\x0b\x0c\r"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and len+1 offsets (from 0) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; other characters have no such bytes in UTF-8."""
    return np.frombuffer(data.tobytes().translate(LOWER), np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words [^\\x20\\x09-\\x0D]+, and for each document the index of its first word (len+1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = before[-1] = True
    before[1:-1] = space[:-1]
    before[offsets] = True
    after = np.empty(len(data) + 1, bool)
    after[:-1] = space
    after[-1] = True
    after[offsets] = True
    word = ~space
    starts = np.flatnonzero(word & before[:-1])
    ends = np.flatnonzero(word & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of data as a binary array; the slices must be in order and apart."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] = 1
    edge[ends] -= 1  # 0 where one slice follows another
    inside = np.cumsum(edge, dtype=np.int8)[:-1].astype(bool)
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data[inside]))])


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code for each word and the distinct words by code."""
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    found = slices(data, starts, ends).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _mixed(h: np.ndarray) -> np.ndarray:
    """The last step of XXH64."""
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of slices of data: those of less than 32 bytes together, by their length."""
    out = np.empty(len(starts), np.uint64)
    padded = np.zeros(len(data) // 8 * 8 + 16, np.uint8)
    padded[: len(data)] = data
    eight = padded.view("<u8")

    def read(at: np.ndarray) -> np.ndarray:
        i, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        # A shift by 64 is none: twice by half of it.
        return (eight[i] >> shift) | (eight[i + 1] << (np.uint64(63) - shift) << np.uint64(1))

    lengths = ends - starts
    short = np.minimum(lengths, 32).astype(np.uint8)
    order = np.argsort(short, kind="stable")
    cuts = np.searchsorted(short[order], np.arange(33)).tolist()
    for n, (i, j) in enumerate(zip(cuts, cuts[1:])):
        for k in range(i, j, 1 << 16):
            own = order[k : min(j, k + (1 << 16))]
            at, h, left = starts[own], np.full(len(own), _P5 + np.uint64(n)), n
            while left >= 8:
                h = _rotated(h ^ (_rotated(read(at) * _P2, 31) * _P1), 27) * _P1 + _P4
                at, left = at + 8, left - 8
            rest = read(at) if left else h
            if left >= 4:
                h = _rotated(h ^ ((rest & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
                rest, left = rest >> np.uint64(32), left - 4
            for _ in range(left):
                h = _rotated(h ^ ((rest & np.uint64(0xFF)) * _P5), 11) * _P1
                rest = rest >> np.uint64(8)
            out[own] = _mixed(h)
    for i in order[cuts[32] :].tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def spark_hash(first: np.ndarray, second: np.ndarray | int) -> np.ndarray:
    """Spark's xxhash64 of a long column and, after it, of another or of an integer literal."""

    def long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
        h = (seed + _P5 + np.uint64(8)) ^ (_rotated(x.astype(np.int64).view(np.uint64) * _P2, 31) * _P1)
        return _mixed(_rotated(h, 27) * _P1 + _P4)

    h = long(first, np.full(len(first), np.uint64(42)))
    if isinstance(second, int):
        return _mixed(_rotated((h + _P5 + np.uint64(4)) ^ (np.full(1, second, np.uint64) * _P1), 23) * _P2 + _P3).view(np.int64)
    return long(second, h).view(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges starts[i] .. starts[i] + lengths[i]."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def keep() -> None:
    """Freed arrays stay with the worker until trim(): else each large one is mapped, and its pages zeroed, again and again."""
    try:
        for kind in (-1, -3):  # M_TRIM_THRESHOLD, M_MMAP_THRESHOLD
            ctypes.CDLL(None).mallopt(kind, 1 << 30)
    except (OSError, AttributeError):
        pass


def trim() -> None:
    """Gives freed memory back: Python workers are used again, and what one holds adds to the next stage's need."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
