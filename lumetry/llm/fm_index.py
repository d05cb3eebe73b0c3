"""An FM-index over a sequence of symbols with separators: backward search for many patterns at a time, in numpy.

Symbol 0 separates. Separators count as different from each other, in the order of their places, so no match runs over
one and suffixes are compared up to the next one only. The Burrows-Wheeler transform is kept in a wavelet matrix whose
bit vectors have a rank directory; suffix positions are sampled every few places and after every separator.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        self.before[1:] = np.cumsum(np.bitwise_count(self.words[:-1]), dtype=np.int64)
        self.zeros = int(len(bits) - np.count_nonzero(bits))

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class Wavelet:
    """A wavelet matrix: rank of a symbol, and the symbol at a place with its rank."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.depth, self.levels = depth, []
        for level in range(depth - 1, -1, -1):
            bits = (symbols >> level) & 1 == 1
            self.levels.append(Bits(bits))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def place(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where `places` of the sequence lead to among the copies of the symbols on the lowest level."""
        for level, bits in zip(range(self.depth - 1, -1, -1), self.levels):
            ones = bits.rank(places)
            places = np.where((symbols >> level) & 1 == 1, bits.zeros + ones, places - ones)
        return places

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at these places, and where they lead to on the lowest level."""
        symbols = np.zeros(len(places), np.int64)
        for bits in self.levels:
            one, ones = bits.get(places), bits.rank(places)
            symbols = 2 * symbols + one
            places = np.where(one, bits.zeros + ones, places - ones)
        return symbols, places


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The places of all suffixes in order; text begins and ends with a separator."""
    n = len(text)
    separators, places = np.flatnonzero(text == 0), np.flatnonzero(text)
    if not len(places):
        return separators
    width = max(1, 62 // depth)
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    key, alive = np.zeros(len(places), np.int64), np.ones(len(places), bool)
    for j in range(width):
        symbols = padded[places + j]
        alive &= symbols > 0
        key = (key << depth) | np.where(alive, symbols, 0)
    by_key = np.argsort(key, kind="stable")
    order, alive, key = places[by_key], alive[by_key], key[by_key]
    # Suffixes that reach a separator within `width` are in order, ties by place; groups of equal others are refined.
    index = np.arange(len(order))
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | ~alive[1:]
    head = np.maximum.accumulate(np.where(new, index, 0))
    rank = np.zeros(n, np.int64)
    rank[separators] = np.arange(len(separators))
    rank[order] = len(separators) + head
    alone = new & np.append(new[1:], True)
    tied, reach = np.flatnonzero(~alone), width
    while len(tied):
        at = order[tied]
        group, following = rank[at], rank[at + reach]
        by = np.lexsort((at, following, group))
        at, group, following = at[by], group[by], following[by]
        order[tied] = at
        new = np.ones(len(tied), bool)
        new[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))
        rank[at] = len(separators) + tied[head]
        tied = tied[~(new & np.append(new[1:], True))]
        reach *= 2
    return np.concatenate([separators, order])


class FMIndex:
    def __init__(self, text: np.ndarray, n_symbols: int):
        """text: symbols from 1 to n_symbols, and separators, one of them first and one last."""
        depth = max(1, int(n_symbols).bit_length())
        text = np.asarray(text, np.int64)
        order = suffix_order(text, depth)
        before = np.where(order > 0, text[order - 1], 0)
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.wavelet = Wavelet(before, depth)
        self.base = self.wavelet.place(np.arange(n_symbols + 1), np.zeros(n_symbols + 1, np.int64))
        sampled = (order % SAMPLE_EVERY == 0) | (before == 0)
        self.sampled, self.samples = Bits(sampled), order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of symbols: the range of suffixes that begin with each."""
        m, length = patterns.shape
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        going = np.arange(m)
        for j in range(length - 1, -1, -1):
            symbols = patterns[going, j]
            shift = self.first[symbols] - self.base[symbols]
            both = self.wavelet.place(np.tile(symbols, 2), np.concatenate([low[going], high[going]]))
            low[going], high[going] = both[: len(going)] + shift, both[len(going) :] + shift
            going = going[low[going] < high[going]]
            if not len(going):
                break
        high = np.maximum(high, low)
        high[np.setdiff1d(np.arange(m), going)] = low[np.setdiff1d(np.arange(m), going)]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places in the text of these suffixes, found by steps to the next sampled one."""
        places, going, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        rows = rows.copy()
        while len(going):
            done = self.sampled.get(rows[going])
            ended = going[done]
            places[ended] = self.samples[self.sampled.rank(rows[ended])] + steps
            going = going[~done]
            symbols, leads = self.wavelet.at(rows[going])
            rows[going] = leads - self.base[symbols] + self.first[symbols]
            steps += 1
        return places
