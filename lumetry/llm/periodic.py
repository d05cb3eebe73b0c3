"""Runs of words that repeat with a period, by longest common extensions over a difference cover.

Places whose remainder modulo V is in a difference cover are sampled, a fifth of all; for any two places there is a shift
of less than V that brings both to samples. Only the suffixes at samples are sorted: by their first V words, then by
doubling what is compared, as the place V words after a sample is one as well. A sparse table over the longest common
prefixes of neighbours answers how far two samples agree, so two places are compared word by word up to the next samples
they share, and looked up from there.

A run of period q that is at least twice as long holds a place on every grid of step q that agrees with the place q words
on. So for each q the grid's places are compared with those q words on, which is n/1 + n/2 + ... comparisons in all, and
those that agree are extended to both sides. The documents of a block are handled together, parted by symbols of their own.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, gathered, spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST = 12  # words of a run
BLOCK = 1 << 18  # characters handled at a time
PAIRS = 1 << 20  # places of the grids looked at together

# A perfect difference set modulo 31. Every remainder is the difference of two of them.
V, COVER = 31, (1, 5, 11, 24, 25, 27)


def _shifts() -> np.ndarray:
    """For two remainders, the least shift that brings both into the cover."""
    inside = np.isin(np.arange(V), COVER)
    a, b, d = np.ogrid[:V, :V, :V]
    return (inside[(a + d) % V] & inside[(b + d) % V]).argmax(2)


SHIFT = _shifts()
NUMBER = np.searchsorted(COVER, np.arange(V))  # of a remainder in the cover


class Extensions:
    """How far the symbols from two places on agree. The last symbol must stand nowhere else."""

    def __init__(self, symbols: np.ndarray):
        self.symbols, self.table = symbols, None

    def _sort(self) -> None:
        """Sort the suffixes at samples, and prepare the minima over their neighbours' common prefixes."""
        n, r = len(self.symbols), len(COVER)
        rounds = -(-n // V)
        places = (np.arange(rounds)[:, None] * V + np.array(COVER)).reshape(-1)
        places = places[places < n]
        padded = np.append(self.symbols, np.zeros(2 * V, self.symbols.dtype))
        first = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, V)[places])
        rank = np.unique(first.view(f"V{first.itemsize * V}").reshape(-1), return_inverse=True)[1]
        ranks, step, m = [rank], r, len(places)
        while rank.max() + 1 < m:  # the sample `step` later is as many words on as are compared already
            later = np.zeros(m, np.int64)
            later[: max(m - step, 0)] = rank[step:] + 1
            rank = np.unique(rank * (m + 1) + later, return_inverse=True)[1]
            ranks.append(rank)
            step *= 2
        order = np.argsort(rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            inside = np.maximum(a, b) < m
            same = np.flatnonzero(inside)[ranks[level][a[inside]] == ranks[level][b[inside]]]
            a[same] += r << level
            b[same] += r << level
            common[same] += V << level
        x, y = places[order[:-1]] + common, places[order[1:]] + common
        alike = np.arange(len(x))
        for k in range(V):
            alike = alike[padded[np.minimum(x[alike] + k, n)] == padded[np.minimum(y[alike] + k, n)]]
            common[alike] += 1
            if not len(alike):
                break
        self.rank = rank
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _samples(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common prefixes of the suffixes at different sampled places."""
        if self.table is None:
            self._sort()
        x, y = (self.rank[p // V * len(COVER) + NUMBER[p % V]] for p in (i, j))
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(float))[1] - 1
        result = np.empty(len(i), np.int64)
        for k in np.unique(level).tolist():
            mine = np.flatnonzero(level == k)
            result[mine] = np.minimum(self.table[k][low[mine]], self.table[k][high[mine] - (1 << k)])
        return result

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The lengths of the longest common extensions of places i != j."""
        shift = SHIFT[i % V, j % V]
        length, differ = shift.copy(), np.zeros(len(i), bool)
        alike = np.arange(len(i))
        for k in range(V):
            alike = alike[shift[alike] > k]
            if not len(alike):
                break
            same = self.symbols[i[alike] + k] == self.symbols[j[alike] + k]
            length[alike[~same]], differ[alike[~same]] = k, True
            alike = alike[same]
        rest = np.flatnonzero(~differ)
        if len(rest):
            length[rest] += self._samples(i[rest] + shift[rest], j[rest] + shift[rest])
        return length


def maximal_runs(symbols: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs in texts of these sizes, whose symbols stand one after the other: text, start, length and period.

    In the order of text, start and period. Symbols are numbers from 0 up.
    """
    none = (np.zeros(0, np.int64),) * 4
    long = np.flatnonzero(sizes >= max(least, 2))
    if not len(long):
        return none
    # Before, between and after the texts a symbol of its own.
    counts = sizes[long]
    first = spans(counts + 1)[:-1] + 1
    ends = np.append(first - 1, first[-1] + counts[-1])
    joined = np.empty(ends[-1] + 1, np.uint32)
    joined[ends] = int(symbols.max()) + 1 + np.arange(len(ends))
    joined[gathered(first, counts)] = symbols[gathered(spans(sizes)[:-1][long], counts)]
    after, before, end = Extensions(joined), Extensions(joined[::-1].copy()), len(joined) - 1

    halves = counts // 2
    of = np.repeat(np.arange(len(long)), halves)
    period = gathered(np.ones(len(long), np.int64), halves)
    step = np.maximum(period, least - period)  # a run has at least so many places that agree with the one a period on
    cells = np.maximum(counts[of] - period - 1, 0) // step + 1
    bounds = spans(cells)
    found = np.zeros((3, 0), np.int64)  # start, end and period
    at, last = 0, int(bounds[-1])
    while at < last:
        until = min(at + PAIRS, last)
        low, high = np.searchsorted(bounds, (at, until), "right") - (1, 0)
        edges = np.clip(bounds[low : min(high, len(cells)) + 1], at, until)
        row = np.repeat(np.arange(low, low + len(edges) - 1), np.diff(edges))
        i = first[of[row]] + (np.arange(at, until) - bounds[row]) * step[row]
        p = period[row]
        agree = np.flatnonzero(joined[i] == joined[i + p])
        i, p, need = i[agree], p[agree], step[row[agree]]
        right, left = after(i, i + p), before(end - i + 1, end - i - p + 1)
        enough = np.flatnonzero(right + left >= need)
        start, stop = (i - left)[enough], (i + right + p)[enough]
        found = np.concatenate([found, [start, stop, p[enough]]], 1)
        # The multiples of a run's period give the same stretch: the least period is the run's.
        found = found[:, np.lexsort(found[::-1])]
        new = np.ones(found.shape[1], bool)
        new[1:] = (found[:2, 1:] != found[:2, :-1]).any(0)
        found, at = found[:, new], until
    start, stop, period = found
    text = np.searchsorted(first, start, "right") - 1
    order = np.lexsort((period, start))
    return long[text][order], (start - first[text])[order], (stop - start)[order], period[order]


def dropped(sizes: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words a run holds after its first period."""
    change = np.zeros(int(sizes.sum()) + 1, np.int64)
    base = spans(sizes)[:-1][text] + start
    np.add.at(change, base + period, 1)
    np.add.at(change, base + length, -1)
    return np.cumsum(change[:-1]) > 0


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _searched(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        runs, collapsed, totals = [], [], []
        for part in blocks(texts, BLOCK):
            number: defaultdict[str, int] = defaultdict(count().__next__)
            words = [WORD.findall(t) for t in texts[part]]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            symbols = np.fromiter((number[w] for own in words for w in own), np.uint32, int(sizes.sum()))
            text, start, length, period = maximal_runs(symbols, sizes, least)
            gone = dropped(sizes, text, start, length, period)
            edges, some = spans(sizes), np.zeros(len(words), bool)
            some[text] = True
            for own, a, b, cut in zip(words, edges[:-1], edges[1:], some.tolist()):
                collapsed.append(" ".join(compress(own, ~gone[a:b]) if cut else own))
            fields = [pa.array(x.astype(np.int64)) for x in (start, length, period)]
            offsets = pa.array(spans(np.bincount(text, minlength=len(words))).astype(np.int32))
            runs.append(pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(RUN))))
            totals.append(sizes)
        if not texts:
            continue
        columns = [pa.array(np.concatenate(totals)), pa.concat_arrays(runs), pa.array(collapsed, pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs and collapsed of every row.

    A word is a stretch without ASCII white space. A run is a stretch of words with a smallest period (words that far
    apart are the same), at least twice the period and `least` words long, that no neighbouring word extends; `runs` has
    start (word number from 0), length and period of each, ordered by start, then period. `collapsed` is the text without
    the words that some run holds after its first period, joined by one blank.

    A null text counts as empty: no words, no runs, an empty `collapsed`. Rows that repeat a doc_id count each; a null
    doc_id stays null. An empty table gives no rows. Columns but doc_id and text are not read. Nothing is shuffled. A
    document is handled whole, in about 250 bytes of a task's memory for each of its words.
    """
    chosen = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    schema = "doc_id LONG, n_words LONG, runs ARRAY<STRUCT<start: LONG, length: LONG, period: LONG>>, collapsed STRING"
    return chosen.mapInArrow(lambda b: _searched(b, least), schema)
