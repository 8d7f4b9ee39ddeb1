"""Compressed FM-index of a sequence of integers: suffix order, Burrows-Wheeler transform, wavelet tree of packed bits."""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with the number of ones before every 64-bit block."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.blocks).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.blocks[at >> 6] & low)


class WaveletTree:
    """Rank of any symbol at any position; one bit vector a level, highest bit of the symbols first."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits]] = []
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bit = (symbols >> shift & 1).astype(np.uint8)
            self.levels.append((shift, Bits(bit)))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def ranges(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        begin = np.zeros(len(symbol), np.int64)
        for shift, bits in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            ranks = [bits.rank(at) for at in (begin, low, high)]
            begin, low, high = (np.where(one, bits.zeros + r, at - r) for r, at in zip(ranks, (begin, low, high)))
        return low - begin, high - begin


def suffix_order(symbols: np.ndarray, length: int) -> np.ndarray:
    """Positions in the order of the ``length`` or more symbols that begin there (doubling)."""
    rank = symbols.astype(np.int64)
    step = 1
    while True:
        following = np.zeros(len(rank), np.int64)
        following[:-step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(np.append(0, sorted_key[1:] != sorted_key[:-1]))
        step *= 2
        if step >= length or rank.max() == len(rank) - 1:
            return order


class FMIndex:
    """Backward search for patterns of up to ``longest`` symbols that occur in the indexed sequence itself."""

    def __init__(self, symbols: np.ndarray, longest: int):
        # Suffixes equal in more symbols than a pattern has may stand in any order: its range stays one range.
        self.symbols = symbols
        self.suffixes = suffix_order(symbols, longest + 1)
        largest = int(symbols.max())
        self.tree = WaveletTree(symbols[self.suffixes - 1], largest)
        self.smaller = np.append(0, np.cumsum(np.bincount(symbols, minlength=largest + 1)))

    def earlier_matches(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the ``length`` symbols that begin at each of ``starts``: the matching statistic and the earliest position.

        The statistic is the number of symbols, from the last one backwards, that also occur elsewhere, up to
        ``length``; the earliest position of all occurrences is told where it is ``length``, else the start itself.
        """
        matched = np.zeros(len(starts), np.int64)
        earliest = starts.copy()
        active = np.arange(len(starts))
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.symbols), np.int64)
        for back in range(length - 1, -1, -1):
            symbol = self.symbols[starts[active] + back]
            low, high = self.tree.ranges(symbol, low, high)
            low, high = low + self.smaller[symbol], high + self.smaller[symbol]
            shared = high - low > 1
            active, low, high = active[shared], low[shared], high[shared]
            matched[active] += 1
            if not len(active):
                return matched, earliest
        ranges, which = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
        least = np.minimum.reduceat(np.append(self.suffixes, 0), ranges.T.ravel())[::2]
        earliest[active] = least[which.ravel()]
        return matched, earliest
