"""Words, word sequences and their 64-bit hashes of a batch of texts, by numpy over the UTF-8 bytes.

A word is ``[^\\x20\\x09-\\x0D]+``; all its separators are ASCII, so bytes can be split without decoding. A null
text has no words. Everything is computed for some MB of text at a time (:func:`slices`), whole texts only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ledgerline.llm.worker import give_back, kept

SLICE_BYTES = 1 << 19

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179))
_SHORT = 32
_AT_A_TIME = 1 << 17


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of MurmurHash3)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _keys(places: np.ndarray, seed: int) -> np.ndarray:
    """An odd random number for each place of a range: the outputs of the SplitMix64 generator, in no simple relation."""
    return mix((places.astype(np.uint64) + np.uint64(1)) * _GOLDEN + _SEEDS[seed]) | np.uint64(1)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of ``values[start:end]`` for each range, equal for equal contents wherever they stand.

    Multilinear: each value times the key of its place in the range, summed modulo 2^64. Keys of different places are
    independent, so no contents collide for a structural reason, as they do under powers of any base modulo 2^64.
    """
    sizes = ends - starts
    total = np.zeros(len(starts), np.uint64)
    longest = int(sizes.max(initial=0))
    if longest <= _SHORT:
        keys = _keys(np.arange(longest), seed)
        same = longest == int(sizes.min(initial=longest))
        for place in range(longest):
            if same:
                total += (values[starts + place].astype(np.uint64) + np.uint64(1)) * keys[place]
            else:
                some = np.flatnonzero(sizes > place)
                total[some] += (values[starts[some] + place].astype(np.uint64) + np.uint64(1)) * keys[place]
    else:
        some = np.flatnonzero(sizes)
        keys, ends_of = _keys(np.arange(longest), seed), np.cumsum(sizes[some])
        at = 0
        while at < len(some):  # some ranges at a time, so that little memory is held
            done = int(ends_of[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends_of, done + _AT_A_TIME, "right")))
            part = some[at:to]
            limits = ends_of[at:to] - sizes[part] - done
            place = np.arange(int(ends_of[to - 1]) - done) - np.repeat(limits, sizes[part])
            found = values[place + np.repeat(starts[part], sizes[part])].astype(np.uint64) + np.uint64(1)
            total[part] = np.add.reduceat(found * keys[place], limits)
            at = to
    return mix(total + sizes.astype(np.uint64) * _GOLDEN)


@dataclass
class Words:
    """The texts of one slice: bytes, text limits in them, and the limits of all words in order."""

    data: np.ndarray
    limits: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, the number of its first word; one more at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return range_hashes(self.data, self.starts, self.ends, seed)

    def text_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and text number of all runs of ``size`` words within one text."""
        owner = self.text_of_words()
        begin = np.arange(len(owner))
        inside = begin + size <= self.first[1:][owner] if len(owner) else np.zeros(0, bool)
        return begin[inside], owner[inside]

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words with one space after each: bytes, and the words' starts and ends in them."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths + 1)
        starts = ends - lengths - 1
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.starts - starts, lengths + 1)
        out = np.append(self.data, np.uint8(0x20))[source] if total else np.zeros(0, np.uint8)
        out[ends - 1] = 0x20
        return out, starts, ends - 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column's texts and the limits of each; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    kind = np.int64 if wide else np.int32
    limits = np.frombuffer(buffers[1], kind, column.offset + len(column) + 1)[column.offset :].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[limits[0] : limits[-1]], limits - limits[0]


def split(column: pa.Array) -> Words:
    data, limits = text_bytes(column)
    word = _IS_WORD[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    begin = limits[:-1][limits[:-1] < limits[1:]]  # of texts that are not empty
    opens[begin] = word[begin]
    last = limits[1:][limits[:-1] < limits[1:]] - 1
    closes[last] = word[last]
    starts = np.flatnonzero(opens)
    return Words(data, limits, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, limits))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES, operator: str = "") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some MB of text; a longer text comes alone, but whole.

    Of what the worker keeps from task to task, only the tables of ``operator`` stay.
    """
    kept(operator)
    for batch in batches:
        if not batch.num_rows:
            continue
        _, limits = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(limits, limits[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    give_back()
