"""Vectorised word and shingle hashing over Arrow string batches (used inside Spark tasks).

A *word* is a maximal run of bytes that are not ASCII white space (space, tab to carriage return).
Words are identified by a 64-bit hash of their bytes; a k-word shingle by a 64-bit hash of its word
hashes in order. A text with 1 to k-1 words has one shingle made of all its words, an empty or null
text has none. Work is done on slices of whole texts of about ``SLICE`` bytes, so memory does not
grow with the batch; one longer text is one slice, hashed window by window.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_WINDOW = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(7))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII bytes that are neither letter nor digit: between the words of texts compared without punctuation.
NO_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _window_powers() -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None:
        up = np.full(_WINDOW, _P, dtype=np.uint64)
        down = np.full(_WINDOW, _PINV, dtype=np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) applied elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without nulls' content; offsets start at 0."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    arr = arr.cast(pa.large_binary())
    if len(arr) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def tidy(batches: Iterator) -> Iterator:
    """Hand on what a task makes and, at its end, give freed memory of the worker back to the machine."""
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of texts that hold about ``size`` bytes together (at least one text each)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends (exclusive) and each text's range of words; ``between`` marks the bytes between words."""
    solid = ~between[data]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    starts[inner] = solid[inner]
    ends = solid.copy()
    ends[:-1] &= starts[1:] | ~solid[1:]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, offsets).astype(np.int64)


def hash_spans(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span (spans ordered and disjoint)."""
    out = np.empty(len(s), dtype=np.uint64)
    up, down = _window_powers()
    a = 0
    while a < len(s):
        base = s[a]
        b = int(np.searchsorted(e, base + _WINDOW, side="right"))
        if b <= a:  # one word longer than a window
            out[a] = int.from_bytes(hashlib.blake2b(data[s[a]:e[a]].tobytes(), digest_size=8).digest(), "little")
            a += 1
            continue
        part = _BYTE[data[base:e[b - 1]]]
        part *= up[:len(part)]
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(part)])
        ls, le = s[a:b] - base, e[a:b] - base
        out[a:b] = mix((total[le] - total[ls]) * down[ls])
        a = b
    return out


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and each text's range as offsets."""
    s, e, off = spans(data, offsets, between)
    return hash_spans(data, s, e), off


def shingles(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order (repeats kept), and each text's range as offsets."""
    n = np.diff(off)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    out_off = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    out = np.zeros(out_off[-1], dtype=np.uint64)
    if len(h) >= k:
        m = len(h) - k + 1
        run = h[:m] * _STEP[0]
        for j in range(1, k):
            run += h[j:m + j] * _STEP[j]
        long = np.where(n >= k, count, 0)
        total = int(long.sum())
        if total:
            at = np.arange(total) - np.repeat(np.cumsum(long) - long, long)
            out[at + np.repeat(out_off[:-1], long)] = run[at + np.repeat(off[:-1], long)]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        v = n[short].astype(np.uint64) * _STEP[k + 1]
        for j in range(k - 1):
            has = n[short] > j
            v[has] += h[off[:-1][short][has] + j] * _STEP[j]
        out[out_off[:-1][short]] = v
    return mix(out), out_off


def sequence_keys(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each text's word sequence: equal texts (by words) have equal pairs."""
    n = np.diff(off)
    pos = (np.arange(len(h)) - np.repeat(off[:-1], n)).astype(np.uint64)
    keys = []
    for c in (3, 5):
        x = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + pos * _STEP[c]), dtype=np.uint64)])
        keys.append((x[off[1:]] - x[off[:-1]] + n.astype(np.uint64)).view(np.int64))
    return keys[0], keys[1]
