"""Token ids of whole texts: each distinct piece between cuts at white space is encoded once and looked up after that.

The cuts are places where the tokenizers' own splitting pattern always begins anew, so the ids are those of the
whole text: before ASCII white space that follows a character that is not white space.
"""

from __future__ import annotations

import os

import numpy as np
from tokenizers import Tokenizer

from fareline.llm.text import SPACE, Texts, equal_ranges, expand, hashes, mixed

_tokenizers: dict[str, PieceEncoder] = {}
#: Pieces kept by one worker; beyond it the table is begun anew (more work, same ids).
KEPT_PIECES = 1_000_000
#: Pieces encoded in one string, and the character that ends them there.
JOINED, MARK = 64, "\x01"


def cuts(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces, and the index of each document's first piece (one more at the end)."""
    data = texts.data
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(texts.bounds), np.int64)
    space = SPACE[data]
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    # Not after white space beyond ASCII (nor after characters that look like it).
    one, two = data[at - 1], data[np.maximum(at - 2, 0)]
    three = data[np.maximum(at - 3, 0)]
    odd = ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | (
        ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
    )
    begins = np.zeros(len(data), bool)
    begins[at[~odd]] = True
    begins[texts.bounds[:-1][np.diff(texts.bounds) > 0]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, texts.bounds)


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(f" {MARK}", add_special_tokens=False).ids
        self._forget()

    def tidy(self) -> None:
        """Begin the table anew if it has grown too large."""
        if len(self.known) > KEPT_PIECES:
            self._forget()

    def _forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.lengths, self.starts, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.sizes, self.begins, self.data = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def _missing(self, kinds: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, kinds)
        if not len(self.known):
            return np.ones(len(kinds), bool)
        return self.known[np.minimum(at, len(self.known) - 1)] != kinds

    def _learn(self, new: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        """Enter the pieces data[start:stop] under their hashes `new` (ascending)."""
        raw, ids, lengths = data.tobytes(), [], []
        pieces = [raw[i:j].decode() for i, j in zip(starts.tolist(), stops.tolist(), strict=True)]
        # Pieces go into a few longer strings, a control character after each: its token ends no other piece.
        joined = SPACE[data[starts]]
        if MARK.encode() in raw:
            joined &= np.array([MARK not in p for p in pieces], bool)
        order = np.append(np.flatnonzero(joined), np.flatnonzero(~joined))
        n, pieces = int(joined.sum()), [pieces[k] for k in order.tolist()]
        strings = ["".join([f"{p} {MARK}" for p in pieces[k : min(k + JOINED, n)]]) for k in range(0, n, JOINED)]
        for k in range(0, len(strings), 64):
            for found in self.tokenizer.encode_batch_fast(strings[k : k + 64], add_special_tokens=False):
                one = np.array(found.ids, np.int32)
                ends = np.flatnonzero(one == self.mark[-1])
                inside = np.ones(len(one), bool)
                for back in range(len(self.mark)):
                    inside[ends - back] = False
                ids.append(one[inside])
                lengths.append(np.diff(ends, prepend=-1) - len(self.mark))
        for found in self.tokenizer.encode_batch_fast(pieces[n:], add_special_tokens=False):
            ids.append(np.array(found.ids, np.int32))
            lengths.append([len(found.ids)])
        lengths = np.concatenate(lengths).astype(np.int32)
        starts, stops, places = starts[order], stops[order], np.empty(len(new), np.int32)
        places[order] = len(self.lengths) + np.arange(len(new))
        at = np.searchsorted(self.known, new)
        self.known, self.place = np.insert(self.known, at, new), np.insert(self.place, at, places)
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths, dtype=np.int64) - lengths)
        self.lengths, self.ids = np.append(self.lengths, lengths), np.concatenate([self.ids, *ids])
        sizes = stops - starts
        self.begins = np.append(self.begins, len(self.data) + np.cumsum(sizes) - sizes)
        self.sizes, self.data = np.append(self.sizes, sizes), np.append(self.data, data[expand(starts, sizes)])

    def _places(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The number in the table of each piece, by hash and then by bytes; pieces that only share a hash with another
        one are entered a second time, under a hash of their own."""
        h = hashes(data, starts, stops)
        while True:
            kinds, example, kind = np.unique(h, return_index=True, return_inverse=True)
            missing = self._missing(kinds)
            if missing.any():
                self._learn(kinds[missing], data, starts[example[missing]], stops[example[missing]])
            place = self.place[np.searchsorted(self.known, kinds)][kind]
            alike = self.sizes[place] == stops - starts
            alike &= equal_ranges(data, starts, self.data, self.begins[place], np.where(alike, stops - starts, 0))
            if alike.all():
                return place
            h = np.where(alike, h, mixed(h))

    def encode(self, texts: Texts, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids with `end` after each document, the bounds of each document's ids, the number of each piece in the
        table (equal for equal pieces, until the table is begun anew), and the index of each document's first piece."""
        starts, stops, first = cuts(texts)
        place = self._places(texts.data, starts, stops)
        lengths = self.lengths[place].astype(np.int64)
        ids = self.ids[expand(self.starts[place], lengths)]
        before = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=before[1:])
        sizes = before[first[1:]] - before[first[:-1]] + 1
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        out = np.full(int(bounds[-1]), end, np.int32)
        inner = np.ones(len(out), bool)
        inner[bounds[1:] - 1] = False
        out[inner] = ids
        return out, bounds, place, first


def encoder(path: str) -> PieceEncoder:
    """One encoder for each file and worker."""
    if path not in _tokenizers:
        _tokenizers[path] = PieceEncoder(path)
    return _tokenizers[path]
