"""Re-Pair grammar compression of id sequences, in rounds, with random access by expansion lengths.

A round counts all adjacent pairs of the sequence, takes those that are frequent, and replaces their occurrences by new
symbols. Where occurrences overlap, that of the more frequent pair wins, and in a run of equal ones every second; a pair
of which too few occurrences win waits for a later round. Rounds go on until one would shorten the sequence by less than
``LEAST_GAIN``. The rules, the length each symbol expands to, and the offset of every ``SAMPLE``-th symbol make any
range of the ids readable without the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerline.llm.pieces import gather

LEAST_COUNT = 4
LEAST_GAIN = 1 / 32
SAMPLE = 1024


def _packed(values: np.ndarray) -> bytes:
    """Numbers in the least of 1, 2, 4 or 8 bytes that holds them all, after one byte that says which."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _chosen(count: np.ndarray) -> np.ndarray:
    """Which of the overlapping occurrences (of a pair at i and at i + 1) win: ``count`` of the pair at each place."""
    padded = np.zeros(len(count) + 2, count.dtype)
    padded[1:-1] = count
    before, after = padded[:-2], padded[2:]
    place = np.arange(len(count))
    in_run = place - np.maximum.accumulate(place * (count != before))
    # The first of a run of equal counts gives way if the place before it has a greater one that is replaced.
    return (count > 0) & (count >= before) & (count >= after) & (in_run & 1 == 0)


def _round(symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence after one round, and the new rules (left, right), the first of which is symbol ``fresh``."""
    keys = symbols[:-1] * fresh + symbols[1:]
    ordered = np.sort(keys)
    limits = np.append(np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])), len(ordered))
    counts = np.diff(limits)
    frequent = np.flatnonzero(counts >= LEAST_COUNT)
    if not len(frequent):
        return symbols, np.zeros((0, 2), np.int64)
    pairs, counts = ordered[limits[frequent]], counts[frequent]
    # A table of hashes finds each place's pair; of two pairs with one slot the more frequent is placed. The last entry is none.
    bits = max(int(4 * len(pairs)).bit_length(), 8)
    shift = np.uint64(64 - bits)
    factor = np.uint64(0x9E3779B97F4A7C15)
    slots = np.full(1 << bits, len(pairs), np.int32)
    rising = np.argsort(counts, kind="stable")
    slots[((pairs[rising].view(np.uint64) * factor) >> shift).view(np.int64)] = rising
    at = slots[((keys.view(np.uint64) * factor) >> shift).view(np.int64)]
    places = _chosen(np.append(counts, 0)[at] * (np.append(pairs, -1)[at] == keys))
    spots = np.flatnonzero(places)
    of = at[spots]
    won = np.bincount(of, minlength=len(pairs))
    kept = won >= LEAST_COUNT
    number = np.cumsum(kept) - 1 + fresh
    spots, of = spots[kept[of]], of[kept[of]]
    result = symbols.copy()
    result[spots] = number[of]
    stays = np.ones(len(symbols), bool)
    stays[spots + 1] = False
    rules = pairs[kept]
    return result[stays], np.stack([rules // fresh, rules % fresh], axis=1)


@dataclass
class Grammar:
    """``alphabet``: the ids that occur; symbol s below its length stands for ``alphabet[s]``, any other for a rule's two
    symbols. ``lengths``: ids that each symbol stands for. ``samples``: ids before every ``SAMPLE``-th symbol."""

    alphabet: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    samples: np.ndarray

    def columns(self) -> dict[str, bytes]:
        parts = {"alphabet": self.alphabet, "rules": self.rules.ravel(), "lengths": self.lengths, "symbols": self.symbols, "samples": self.samples}
        return {name: _packed(values) for name, values in parts.items()}

    @staticmethod
    def of_columns(columns: dict[str, bytes]) -> Grammar:
        parts = {name: _unpacked(columns[name]) for name in ("alphabet", "rules", "lengths", "symbols", "samples")}
        return Grammar(**(parts | {"rules": parts["rules"].reshape(-1, 2)}))

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """Replace rule symbols by their two symbols until none is left."""
        terminals = len(self.alphabet)
        while len(deep := np.flatnonzero(symbols >= terminals)):
            sizes = np.ones(len(symbols), np.int64)
            sizes[deep] = 2
            starts = np.cumsum(sizes) - sizes
            pairs = self.rules[symbols[deep] - terminals]
            symbols = np.repeat(symbols, sizes)
            symbols[starts[deep]], symbols[starts[deep] + 1] = pairs[:, 0], pairs[:, 1]
        return self.alphabet[symbols]

    def all(self) -> np.ndarray:
        """The whole sequence. Each rule is expanded once, those of one depth together, and copied to its places."""
        terminals = len(self.alphabet)
        flat = [self.alphabet]
        starts = np.zeros(len(self.lengths), np.int64)
        starts[:terminals] = np.arange(terminals)
        used, done = terminals, terminals
        whole = self.alphabet
        while done < len(self.lengths):
            # Rules up to the first that needs one of this very group.
            needs = self.rules[done - terminals :].max(axis=1)
            to = done + int(np.argmax(np.append(needs, len(self.lengths)) >= done))
            pairs = self.rules[done - terminals : to - terminals].ravel()
            sizes = self.lengths[done:to]
            starts[done:to] = used + np.cumsum(sizes) - sizes
            flat.append(whole[gather(starts[pairs], self.lengths[pairs])])
            whole = np.concatenate(flat)
            flat = [whole]
            used, done = len(whole), to
        return whole[gather(starts[self.symbols], self.lengths[self.symbols])]

    def range(self, start: int, size: int) -> np.ndarray:
        """Ids ``start`` to ``start + size``: from the sample before them, by expansion lengths; nothing else is expanded."""
        if size <= 0:
            return np.zeros(0, np.int64)
        first = max(int(np.searchsorted(self.samples, start, "right")) - 1, 0)
        last = int(np.searchsorted(self.samples, start + size, "left"))
        symbols = self.symbols[first * SAMPLE : last * SAMPLE]
        ends = self.samples[first] + np.cumsum(self.lengths[symbols])
        left = int(np.searchsorted(ends, start, "right"))
        right = int(np.searchsorted(ends, start + size, "left")) + 1
        begin = int(ends[left] - self.lengths[symbols[left]])
        return self._expanded(symbols[left:right])[start - begin : start - begin + size]


def compress(ids: np.ndarray) -> Grammar:
    """The grammar of a sequence of numbers from 0 on."""
    present = np.zeros(int(ids.max(initial=0)) + 1, bool)
    present[ids] = True
    alphabet = np.flatnonzero(present)
    code = np.cumsum(present) - 1
    symbols = code[ids]
    fresh = len(alphabet)
    rules = [np.zeros((0, 2), np.int64)]
    lengths = [np.ones(fresh, np.int64)]
    while len(symbols) > 1:
        shorter, added = _round(symbols, fresh)
        if not len(added) or len(symbols) - len(shorter) < LEAST_GAIN * len(symbols):
            break
        known = np.concatenate(lengths)
        lengths = [known, known[added[:, 0]] + known[added[:, 1]]]
        rules.append(added)
        fresh += len(added)
        symbols = shorter
    sizes = np.concatenate(lengths)
    before = np.cumsum(sizes[symbols]) - sizes[symbols]
    return Grammar(alphabet, np.concatenate(rules), sizes, symbols, before[::SAMPLE])
