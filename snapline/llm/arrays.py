"""Words of Arrow text columns as flat numpy arrays; used inside Spark tasks only."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

# Bytes that one vectorised step looks at: bounds its memory to some twenty times as much.
PIECE = 1 << 20

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15 | 1
_MIX = _U(0xBF58476D1CE4E5B9)


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: is it part of a word (digits, ASCII letters, all of UTF-8 beyond ASCII), and its lower case."""
    code = np.arange(256)
    upper = (code >= 65) & (code <= 90)
    word = ((code >= 48) & (code <= 57)) | upper | ((code >= 97) & (code <= 122)) | (code >= 128)
    return word, np.where(upper, code + 32, code).astype(np.uint8)


IS_WORD, LOWER = _letters()

# Multipliers and turns of one step of the word hash, and words (bytes) beyond which a library hashes one at a time.
_M1, _M2 = _U(0x9E3779B185EBCA87), _U(0xC2B2AE3D27D4EB4F)
_LANE, LONG_WORD = 8, 1 << 12


def powers(n: int, base: int = _STEP) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_UP, _DOWN = powers(PIECE), powers(PIECE, pow(_STEP, -1, 1 << 64))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` for many spans at once: differences of one
    running polynomial sum, so that overlapping spans cost nothing more.

    For short n-grams that go to buckets, and for picking places, only: modulo a power of two some
    different strings of 512 bytes and more agree whatever the base. What counts as equal is told by
    :func:`hash_words`.
    """
    up, down = (_UP, _DOWN) if len(data) <= PIECE else (powers(len(data)), powers(len(data), pow(_STEP, -1, 1 << 64)))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(value[data] * up[: len(data)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    h ^= h >> _U(31)
    h *= _MIX
    h ^= (end - start).astype(np.uint64)
    h *= _MIX
    return h ^ (h >> _U(29))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` for many short spans at once, eight bytes a step."""
    n = end - start
    h = n.astype(np.uint64) * _M2
    padded = np.concatenate([data, np.zeros(_LANE, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    live, at = np.flatnonzero((n > 0) & (n <= LONG_WORD)), 0
    while len(live):
        left = n[live] - at
        lane = eight[start[live] + at] & (_U(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(_LANE - left, 0)).astype(np.uint64))
        mixed = _turned(lane * _M2, 31) * _M1
        h[live] = _turned(h[live] ^ mixed, 27) * _M1 + _M2
        at += _LANE
        live = live[left > _LANE]
    for i in np.flatnonzero(n > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes(), seed=int(h[i]))
    h ^= h >> _U(33)
    h *= _MIX
    h ^= h >> _U(29)
    h *= _M2
    return h ^ (h >> _U(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows (null: empty)."""
    column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, but of one row at least."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high
        low = high


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches, small ones together up to about ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held and sum(len(b) for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


@dataclass
class Words:
    """Hash of each word of some rows, and where the words of each row begin."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Words ``[0-9A-Za-z\\x80-]+`` (hashed in lower case) of whole texts, however long."""
    hashes, starts = [], []
    low, n = 0, len(data)
    while low < n:
        high = min(n, low + PIECE)
        if high < n:  # cut between words; only a word longer than a piece makes a longer one
            gaps = np.flatnonzero(~IS_WORD[data[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            else:
                while high < n and IS_WORD[data[high : high + PIECE]].all():
                    high = min(n, high + PIECE)
                rest = np.flatnonzero(~IS_WORD[data[high : high + PIECE]])
                high = min(n, high + (int(rest[0]) if len(rest) else 0))
        part = data[low:high]
        inside = np.zeros(len(part) + 2, dtype=bool)
        inside[1:-1] = IS_WORD[part]
        # A row's first byte begins a word even where the row before ended in one.
        cuts = bounds[np.searchsorted(bounds, low, "left") : np.searchsorted(bounds, high, "left")] - low
        begin = inside[1:-1] & ~inside[:-2]
        begin[cuts] |= inside[1:-1][cuts]
        stop = inside[1:-1] & ~inside[2:]
        before = cuts[cuts > 0] - 1
        stop[before] |= inside[1:-1][before]
        at, to = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        hashes.append(hash_words(LOWER[part], at, to))
        starts.append(at + low)
        low = high
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.searchsorted(start, bounds, "left"))


def release() -> None:
    """Give memory back that Arrow and the C library hold without use: Spark's workers go on to other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ragged(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists ``first[i] .. first[i]+count[i]-1``: the list of each element, and the element."""
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return owner, first[owner] + inside
