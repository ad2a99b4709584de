"""Token ids of many texts at once, with one tokenizer call for each distinct piece.

A BPE tokenizer first cuts a text into pieces (words with their space, runs of
digits or marks) and then looks at each piece alone. Here numpy cuts a whole
group of texts and hashes the pieces; ids of pieces seen before come from a
table, the others are given to the tokenizer's model. Texts with characters
outside :data:`SAFE`, or with the literal of a token that the file adds to the model,
go to the tokenizer whole. Ids equal the tokenizer's own, added tokens included.
"""

from __future__ import annotations

import os

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from ordermill.llm.common import span_hashes  # noqa: E402

# Entries that the table of known pieces may reach; then it is begun anew.
MOST_PIECES = 1 << 20

# Fixed values. SAFE: tab, newline, printable ASCII, Latin-1 letters, and both cases of oe.
SAFE = "\t\n -~À-ÖØ-öø-ÿŒœ"
BLANK, LETTER, DIGIT, MARK, SHORTENED, UNSAFE = range(6)
SHORT_ONE, SHORT_TWO = b"stmd", (b"re", b"ve", b"ll")

_CLASS = np.full(256, UNSAFE, np.uint8)
_CLASS[0x21:0x7F] = MARK
_CLASS[[0x09, 0x0A, 0x20]] = BLANK
_CLASS[0x30:0x3A] = DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = LETTER
_CLASS[0x80:0xC0] = LETTER
_CLASS[[0xC3, 0xC5]] = LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _byte_alphabet() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_ALPHABET = _byte_alphabet()


def _previous(data: np.ndarray) -> np.ndarray:
    before = np.empty_like(data)
    before[:1] = 0
    before[1:] = data[:-1]
    return before


def unsafe_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows have a character outside :data:`SAFE`."""
    bad = _CLASS[data] == UNSAFE
    if (data >= 0x80).any():
        before = _previous(data)
        bad |= (before == 0xC3) & ((data == 0x97) | (data == 0xB7))
        bad |= (before == 0xC5) & (data != 0x92) & (data != 0x93)
    rows = np.searchsorted(offsets, np.flatnonzero(bad), "right") - 1
    unsafe = np.zeros(len(offsets) - 1, bool)
    unsafe[rows] = True
    return unsafe


def rows_with(data: np.ndarray, offsets: np.ndarray, literals: list[bytes]) -> np.ndarray:
    """Which rows have one of the literals, or share one with the next row."""
    whole, found = data.tobytes(), np.zeros(len(offsets) - 1, bool)
    for literal in literals:
        at = whole.find(literal)
        while at >= 0:
            found[np.searchsorted(offsets, at, "right") - 1] = True
            at = whole.find(literal, at + 1)
    return found


def lower(data: np.ndarray) -> np.ndarray:
    """Lower-case safe UTF-8 bytes."""
    out = _LOWER[data]
    if (out >= 0x80).any():
        before = _previous(data)
        out[(before == 0xC3) & (data < 0x9F)] += 0x20
        out[(before == 0xC5) & (data == 0x92)] = 0x93
    return out


def cut(data: np.ndarray, offsets: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces that tile the bytes, and each piece's class.

    ``spaced``: a space belongs to the piece after it and digits form runs; else
    blanks stand apart and each digit is a piece.
    """
    size = len(data)
    kind = _CLASS[data]
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    ends_row = first[1:]
    first = first[:-1]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]

    marks = np.flatnonzero((data == 0x27) & start)
    if spaced and len(marks):
        marks = marks[first[marks] | (data[marks - 1] != 0x20)]
    if len(marks):
        # Up to two bytes after the mark, 0 beyond the end of its text.
        padded, edge = np.concatenate([data, [0, 0]]), np.concatenate([ends_row, [True, True]])
        one = np.where(edge[marks], 0, padded[marks + 1])
        two = np.where(edge[marks] | edge[marks + 1], 0, padded[marks + 2])
        length = np.where(np.isin(one, np.frombuffer(SHORT_ONE, np.uint8)), 2, 0)
        for pair in SHORT_TWO:
            length = np.where((one == pair[0]) & (two == pair[1]), 3, length)
        marks, length = marks[length > 0], length[length > 0]
        for i in range(3):
            kind[(marks + i)[length > i]] = SHORTENED
        start = first.copy()
        start[1:] |= kind[1:] != kind[:-1]
        start[marks] = True
    if spaced:
        # A run of blanks before something else gives its last one up: to the next piece if a space, else alone.
        last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~ends_row[:-1])
        start[last] = True
        start[last[data[last] == 0x20] + 1] = False
    else:
        start |= kind == DIGIT
    starts = np.flatnonzero(start)
    return starts, kind[starts]


class PieceEncoder:
    """Ids of texts by a tokenizer file; ``spaced`` says which of two ways of cutting it has."""

    def __init__(self, path: str, spaced: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.spaced = self.tokenizer.model, spaced
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        slots = 2 * MOST_PIECES
        self.keys = np.zeros(slots, np.uint64)
        self.at, self.count = np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self.ids, self.used, self.known = np.zeros(1 << 16, np.uint32), 0, 0

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot that holds each hash, or the empty one where it would go."""
        most = np.uint64(len(self.keys) - 1)
        slots = (hashes & most).astype(np.int64)
        held = self.keys[slots]
        wrong = np.flatnonzero((held != hashes) & (held != 0))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & int(most)
            held = self.keys[slots[wrong]]
            wrong = wrong[(held != hashes[wrong]) & (held != 0)]
        return slots

    def _learn(self, pieces: list[bytes], hashes: np.ndarray) -> None:
        found = [
            [token.id for token in self.model.tokenize(piece.decode("latin-1").translate(_ALPHABET))]
            for piece in pieces
        ]
        counts = np.fromiter(map(len, found), np.int32, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        begins = self.used + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.used += len(flat)
        self.known += len(found)
        left = np.arange(len(found))
        while len(left):
            # Of those that meet in one empty slot the first takes it, the others look on.
            slots, first = np.unique(self._slots(hashes[left]), return_index=True)
            taken = left[first]
            self.keys[slots], self.at[slots], self.count[slots] = hashes[taken], begins[taken], counts[taken]
            left = np.delete(left, first)

    def _safe(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if not self.spaced:
            data = lower(data)
        starts, kinds = cut(data, offsets, self.spaced)
        ends = np.append(starts[1:], len(data))
        hashes = np.maximum(span_hashes(data, starts, ends), np.uint64(1))
        if not self.spaced:
            keep = kinds != BLANK
            starts, ends, hashes = starts[keep], ends[keep], hashes[keep]
        slots = self._slots(hashes)
        new = np.flatnonzero(self.keys[slots] == 0)
        if len(new):
            fresh, where = np.unique(hashes[new], return_index=True)
            where, whole = new[where], data.tobytes()
            if self.known + len(fresh) > MOST_PIECES:
                self._clear()
                fresh, where = np.unique(hashes, return_index=True)
            while self.known + len(fresh) > len(self.keys) // 2:
                self.keys = np.zeros(2 * len(self.keys), np.uint64)
                self.at, self.count = np.zeros(len(self.keys), np.int64), np.zeros(len(self.keys), np.int32)
            self._learn([whole[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)], fresh)
            slots = self._slots(hashes)
        counts = self.count[slots]
        bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        ids = self.ids[np.arange(bounds[-1]) + np.repeat(self.at[slots] - bounds[:-1], counts)]
        return ids, bounds[np.searchsorted(starts, offsets)]

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a group of texts, each with ``end_id`` after it, and where each text's ids begin."""
        rows = len(offsets) - 1
        unsafe = unsafe_rows(data, offsets) | rows_with(data, offsets, self.added)
        if unsafe.any():
            spans = [(offsets[i], offsets[i + 1]) for i in range(rows)]
            whole = [bytes(data[a:b]).decode() for (a, b), bad in zip(spans, unsafe, strict=True) if bad]
            slow = iter([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)])
            safe = [data[a:b] for (a, b), bad in zip(spans, unsafe, strict=True) if not bad]
            inner = np.concatenate([[0], np.cumsum([len(x) for x in safe])]).astype(np.int64)
            ids, begins = self._safe(np.concatenate([*safe, np.zeros(0, np.uint8)]), inner)
            fast = iter([ids[begins[i] : begins[i + 1]] for i in range(len(safe))])
            parts = [next(slow) if bad else next(fast) for bad in unsafe]
            begins = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
            ids = np.concatenate([*parts, np.zeros(0, np.uint32)])
        else:
            ids, begins = self._safe(data, offsets)
        out = np.full(len(ids) + rows, end_id, np.uint32)
        spread = np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(begins))
        out[spread] = ids
        return out, begins + np.arange(rows + 1)


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaced: bool) -> PieceEncoder:
    """The encoder of this worker process; its table outlives a task."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = PieceEncoder(path, spaced)
    return _encoders[path, spaced]
