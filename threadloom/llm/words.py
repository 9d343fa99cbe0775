"""Words of Arrow text columns as arrays: byte spans, 64-bit hashes, n-gram hashes.

A batch of texts is handled as one byte array (the column's own buffer), so the
work per text is a few vector operations and no Python object is made per word.
Slices hold whole texts of about two megabytes together; hashing itself works
on blocks of words, so a single long text needs memory in proportion to its
bytes only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

SLICE_BYTES = 1 << 21
#: bytes whose polynomial hashes come from one running sum
BLOCK_BYTES = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = _U(0xD6E8FEB86659FD93)
_BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def _give_back() -> None:
    """Large arrays go back to the system when they are freed.

    Workers are kept from stage to stage, and the allocators keep what a worker
    once needed; beside a full JVM heap that is what an executor lacks.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD; stating it keeps it from growing
    except (OSError, AttributeError):
        pass  # another C library


_give_back()


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table over bytes, true inside the inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: everything but space, tab, line feed, vertical tab, form feed, carriage return
NON_SPACE = ~(byte_class((9, 13), (32, 32)))
#: digits, lower-case letters and every byte of a character beyond ASCII
ALPHANUMERIC = byte_class((48, 57), (97, 122), (128, 255))


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (a bijection)."""
    values = values ^ (values >> _U(32))
    values = values * _STEP
    values = values ^ (values >> _U(29))
    values = values * _U(0xA0761D6478BD642F)
    return values ^ (values >> _U(32))


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, offsets) of runs of whole texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    if not rows:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset : column.offset + rows + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of bytes of a class."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    word = inside[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _powers() -> list[np.ndarray]:
    """Powers of the base and of its inverse, as many as a block has bytes."""
    if not _POWERS:
        for value in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(BLOCK_BYTES + POLYNOMIAL_BYTES + 1, value, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


#: a polynomial modulo 2^64 loses bits on long texts of a built pattern (Thue-Morse); longer spans are hashed one by one
POLYNOMIAL_BYTES = 32


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH3 of the bytes of each span."""
    view = memoryview(np.ascontiguousarray(data))
    return np.fromiter((xxh3_64_intdigest(view[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())), dtype=np.uint64, count=len(starts))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes give equal hashes anywhere.

    A polynomial over random byte codes, taken from a running sum, block by
    block; XXH3 for spans beyond ``POLYNOMIAL_BYTES``.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    long = ends - starts > POLYNOMIAL_BYTES
    at = np.flatnonzero(long)
    out[at] = byte_hashes(data, starts[at], ends[at])
    at = np.flatnonzero(~long)
    starts, ends, first = starts[at], ends[at], 0
    up, down = _powers()
    while first < len(at):
        last = max(int(np.searchsorted(ends, starts[first] + BLOCK_BYTES, side="right")), first + 1)
        low, high = int(starts[first]), int(ends[last - 1])
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[data[low:high]] * down[: high - low], out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[at[first:last]] = mix((sums[b] - sums[a]) * up[a] + (b - a).astype(np.uint64))
        first = last
    return out


def gram_hashes(words: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words and which of them lie in one text.

    Entry i belongs to words i .. i+n-1; both arrays are shorter than ``words``
    by n-1 (empty when there are fewer words).
    """
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    total = np.full(count, n, dtype=np.uint64)
    for j in range(n):
        total = total * _STEP + words[j : j + count]
    return mix(total), texts[:count] == texts[n - 1 :]
