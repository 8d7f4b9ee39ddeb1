"""Texts as runs of known pieces: cut in Arrow, encoded once a piece, kept in a table bounded by bytes.

A piece ends before a single space between two characters that are not white space: there every match of the usual
byte-level splitting pattern ends too, so encoding the pieces one by one gives the ids of the whole text.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ENTRY_BYTES = 190  # of a short text and its number in a dictionary


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + sizes, sizes)


class Generation:
    """Pieces and their ids in one growing array."""

    def __init__(self, kind: np.dtype):
        self.number: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, kind)
        self.starts = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.text_bytes = 0

    @property
    def size(self) -> int:
        return self.text_bytes + len(self.number) * (_ENTRY_BYTES + 8) + self.used * self.flat.itemsize

    def add(self, pieces: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        first, used = len(self.number), self.used
        while used + len(flat) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        while first + len(pieces) >= len(self.starts):
            self.starts = np.append(self.starts, np.zeros_like(self.starts))
        self.flat[used : used + len(flat)] = flat
        self.starts[first + 1 : first + 1 + len(pieces)] = used + np.cumsum(sizes)
        self.used += len(flat)
        self.text_bytes += sum(map(len, pieces))
        self.number.update(zip(pieces, range(first, first + len(pieces))))

    def lookup(self, pieces: list[str]) -> np.ndarray:
        """Number of each piece, -1 if it is unknown."""
        return np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.starts[numbers]
        sizes = self.starts[numbers + 1] - starts
        return self.flat[gather(starts, sizes)], sizes


class Pieces:
    """Ids of pieces. What is not known is encoded and kept; when the table passes half of ``max_bytes``, it becomes the
    old one, from which pieces in use are taken over, and what stays unused goes with it at the next change."""

    def __init__(self, encode: Callable[..., tuple[np.ndarray, np.ndarray]], kind: type = np.int32, max_bytes: int = 256 << 20, own: bool = False):
        """``own``: ``encode`` takes this table as its second argument."""
        self.encode = (lambda pieces: encode(pieces, self)) if own else encode
        self.kind, self.max_bytes = np.dtype(kind), max_bytes
        self.young, self.old = Generation(self.kind), Generation(self.kind)

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row, and the number of ids of each."""
        if self.young.size > self.max_bytes // 2:
            self.old, self.young = self.young, Generation(self.kind)
        numbers = self.young.lookup(pieces)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            asked = [pieces[i] for i in missing.tolist()]
            left = list(dict.fromkeys(asked))
            first, in_old = len(self.young.number), self.old.lookup(left)
            known = in_old >= 0
            if known.any():
                self.young.add([left[i] for i in np.flatnonzero(known).tolist()], *self.old.ids(in_old[known]))
            if not known.all():
                fresh = [left[i] for i in np.flatnonzero(~known).tolist()]
                self.young.add(fresh, *self.encode(fresh))
            if len(left) < len(asked):
                numbers[missing] = self.young.lookup(asked)
            else:  # numbered as they were added
                numbers[missing] = first + np.where(known, np.cumsum(known), known.sum() + np.cumsum(~known)) - 1
        return self.young.ids(numbers)


def _space_free(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each text begins and ends with a character that is surely not white space. A text that is empty does not."""
    found = []
    # The Arrow pattern class and Python's differ in some control characters, so both are ruled out.
    for pattern in (r"^[^\p{Z}\pC]", r"[^\p{Z}\pC]$"):
        found.append(pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False))
    return found[0], found[1]


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The pieces of all texts (a few may be listed twice), the number of the piece at each place, and the places where the
    texts begin."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    lists = pc.split_pattern(texts, " ")
    limits = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    limits = limits - limits[0] if len(limits) else np.zeros(1, np.int64)
    opens, closes = _space_free(words)
    head = np.zeros(len(codes) + 1, bool)
    head[limits] = True
    head = head[: len(codes)]
    safe = np.append(True, closes[codes[:-1]] & opens[codes[1:]]) if len(codes) else np.zeros(0, bool)
    begins = np.flatnonzero(head | safe)  # of each piece, its first word
    sizes = np.diff(np.append(begins, len(codes)))
    # A piece of one word is told by the word and whether a space comes before it; longer ones are joined again.
    keys = codes[begins] * 2 + ~head[begins]
    single = sizes == 1
    place = np.zeros(2 * len(words) + 1, np.int64)
    place[keys[single]] = 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used))
    number = place[keys]
    listed = words.to_numpy(zero_copy_only=False).tolist()  # much quicker than to_pylist
    pieces = [" " + listed[key >> 1] if key & 1 else listed[key >> 1] for key in used.tolist()]
    longer: dict[str, int] = {}
    for at in np.flatnonzero(~single).tolist():
        begin = begins[at]
        parts = " ".join([listed[code] for code in codes[begin : begin + sizes[at]].tolist()])
        piece = parts if head[begin] else " " + parts
        number[at] = len(used) + longer.setdefault(piece, len(longer))
    return pieces + list(longer), number, np.searchsorted(begins, limits)


def joined(lists: list[list[str]], table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of lists of words, one after the other, and the number of ids of each list."""
    numbers: dict[str, int] = {}
    of = np.array([numbers.setdefault(word, len(numbers)) for found in lists for word in found], np.int64)
    flat, sizes = table.ids(list(numbers))
    starts = np.cumsum(sizes) - sizes
    total = np.append(0, np.cumsum(sizes[of]))
    limits = np.append(0, np.cumsum([len(found) for found in lists])).astype(np.int64)
    return flat[gather(starts[of], sizes[of])], np.diff(total[limits])


def encoded(texts: pa.Array, table: Pieces, cut: Callable = cut) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in a row (a null text: none), and the number of ids of each text. ``cut``: how the pieces are told."""
    pieces, number, limits = cut(texts)
    flat, sizes = table.ids(pieces)
    starts = np.cumsum(sizes) - sizes
    of = sizes[number]
    total = np.append(0, np.cumsum(of))
    return flat[gather(starts[number], of)], np.diff(total[limits])
