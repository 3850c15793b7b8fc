"""The words of a slice of texts with 64-bit keys and their bytes (used inside Spark tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.llm import batch as bt

#: Bytes of a slice of whole texts; a longer text is a slice of its own.
SLICE = 4 << 20
_COMPARED = 1 << 16
#: ASCII capitals as small letters, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def bytes_of(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the bytes of all spans one after the other, and the spans' sizes."""
    size = e - s
    return np.arange(size.sum()) + np.repeat(s - (np.cumsum(size) - size), size), size


class Words:
    """Spans, texts and keys of the words between the bytes that ``between`` marks; A-Z count as a-z.

    Equal words of texts with equal salts have equal keys; whether unequal words do is for the caller to check.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, between: np.ndarray, salts: np.ndarray, seed: int = 0):
        self.low = LOWER[data]
        self.s, self.e, per_text = bt.spans(data, off, between)
        bytes_of_seed = np.random.Generator(np.random.PCG64(seed)).permutation(256).astype(np.uint8)
        self.text = np.repeat(np.arange(len(off) - 1), np.diff(per_text))
        self.key = bt.mix(bt.hash_spans(bytes_of_seed[self.low], self.s, self.e) ^ salts[self.text])

    def texts(self, at: np.ndarray) -> pa.Array:
        """The words at these places as strings."""
        places, size = bytes_of(self.s[at], self.e[at])
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.low[places])).cast(pa.string())

    def unlike(self, other: np.ndarray) -> np.ndarray:
        """Places of the words whose bytes are not those of the word at ``other``."""
        size = self.e - self.s
        same = size == size[other]
        every = np.flatnonzero(same & (other != np.arange(len(other))))
        for lo in range(0, len(every), _COMPARED):
            at = every[lo:lo + _COMPARED]
            mine, n = bytes_of(self.s[at], self.e[at])
            theirs, _ = bytes_of(self.s[other[at]], self.e[other[at]])
            wrong = self.low[mine] != self.low[theirs]
            if wrong.any():
                same[at[np.unique(np.repeat(np.arange(len(at)), n)[wrong])]] = False
        return np.flatnonzero(~same)


def runs(order: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal rows begins in ``order``, and the place of the run's first row for every row."""
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    at = np.flatnonzero(new)
    first = np.empty(len(order), dtype=np.int64)
    first[order] = np.repeat(order[at], np.diff(np.concatenate([at, [len(order)]])))
    return at, first
