"""Token ids of whole texts with a public byte-level BPE vocabulary, cached by word.

The vocabulary's split pattern never joins what stands before a run of white space to what follows, so a text is
cut before each ASCII white-space run and pieces are looked up in the worker's table of remembered pieces; the
missing ones are encoded together. Texts with other white space (where the cut could fall inside a run) are encoded as a whole. The ids equal those of the
plain encoder.
"""

from __future__ import annotations

import base64

import numpy as np

from tessera.llm import batch as bt

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern of the byte-level vocabularies (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: UTF-8 beginnings of white space outside ASCII (fixed values).
WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80\x80")
#: Slots of the table of remembered pieces per worker, and the ids it may hold before it is emptied (no effect on results).
SLOTS, REMEMBERED = 1 << 21, 1 << 23
_OPEN: dict[str, Encoder] = {}


class Encoder:
    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.bytes_of = np.zeros(self.size, dtype=np.int64)
        self.bytes_of[list(ranks.values())] = list(map(len, ranks))
        self.key, self.begin, self.count = np.empty(SLOTS, np.uint64), np.empty(SLOTS, np.int32), np.empty(SLOTS, np.int32)
        self.ids = np.zeros(REMEMBERED, dtype=np.uint32)
        self._forget()

    def _forget(self) -> None:
        self.key[:], self.used = 0, 0

    def _encode_new(self, raw: bytes, data: np.ndarray, b: np.ndarray, e: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces [b, e) in order and their counts. Pieces that begin with white space and end without are joined
        into one text for the encoder: their borders are borders of the pattern, and id lengths tell the ids apart."""
        counts = np.zeros(len(b), dtype=np.int64)
        joint = np.flatnonzero(~alone)
        n = (e - b)[joint]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(b[joint], n)
        ids = np.array(self.plain.encode_ordinary(data[at].tobytes().decode("utf-8", "replace")), dtype=np.uint32)
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(n)) + 1
        counts[joint] = np.diff(ends, prepend=0)
        single = np.flatnonzero(alone)
        own = [np.array(self.plain.encode_ordinary(raw[b[i]:e[i]].decode("utf-8", "replace")), dtype=np.uint32) for i in single]
        counts[single] = list(map(len, own))
        out, place = np.empty(int(counts.sum()), dtype=np.uint32), np.cumsum(counts) - counts
        c = counts[joint]
        out[np.arange(len(ids)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(place[joint], c)] = ids
        for i, x in zip(single, own):
            out[place[i]:place[i] + len(x)] = x
        return out, counts

    def _pieces(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, count, offsets): where the ids of each piece stand, and each text's range of pieces."""
        raw = data.tobytes()
        _, ends, _ = bt.spans(data, off)
        # a piece ends where a word ends; white space after the last word is a piece of its own
        size = np.diff(off)
        ends = np.sort(np.concatenate([ends, off[1:][size > 0]]), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]
        wide = np.zeros(len(size), dtype=bool)
        for w in WIDE_SPACE:
            at = raw.find(w)
            while at >= 0:
                t = int(np.searchsorted(off, at, side="right")) - 1
                wide[t] = True
                at = raw.find(w, off[t + 1])
        for t in np.flatnonzero(wide):
            ends = ends[(ends <= off[t]) | (ends >= off[t + 1])]
        begins = np.concatenate([ends[:0], [0], ends[:-1]]) if len(ends) else ends
        h = bt.hash_spans(data, begins, ends) | np.uint64(1)
        slot = (h >> np.uint64(1)).astype(np.int64) & (SLOTS - 1)
        ids, begin, count = self.ids, self.begin[slot].astype(np.int64), self.count[slot].astype(np.int64)
        new = np.flatnonzero(self.key[slot] != h)
        if len(new):
            order = new[np.argsort(h[new], kind="stable")]
            fresh = np.diff(h[order], prepend=h[order[0]] ^ np.uint64(2)) != 0
            first = order[fresh]
            alone = (~bt.SPACE[data[begins[first]]] | bt.SPACE[data[ends[first] - 1]]
                     | wide[np.searchsorted(off, begins[first], side="right") - 1])
            found, n = self._encode_new(raw, data, begins[first], ends[first], alone)
            if self.used + len(found) > REMEMBERED:  # earlier ids of this slice are still needed: give them their own copy
                ids = np.concatenate([self.ids[:self.used], found])
                place, keep = self.used + np.cumsum(n) - n, False
            else:
                self.ids[self.used:self.used + len(found)] = found
                place, keep = self.used + np.cumsum(n) - n, True
            number = np.cumsum(fresh) - 1
            begin[order], count[order] = place[number], n[number]
            if keep:
                self.used += len(found)
                self.key[slot[first]], self.begin[slot[first]], self.count[slot[first]] = h[first], place, n
            else:
                self._forget()
        return ids, begin, count, np.searchsorted(ends, off, side="right")

    def counts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Number of token ids of each text."""
        _, _, n, piece_off = self._pieces(data, off)
        total = np.concatenate([[0], np.cumsum(n)])
        return total[piece_off[1:]] - total[piece_off[:-1]]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in order, and each text's range as offsets."""
        ids, begin, n, piece_off = self._pieces(data, off)
        total = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(int(total[-1])) - np.repeat(total[:-1], n) + np.repeat(begin, n)
        return ids[at], total[piece_off]


def encoder(path: str = DEFAULT_VOCABULARY) -> Encoder:
    """The worker's encoder for a vocabulary file (opened once per worker)."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]
