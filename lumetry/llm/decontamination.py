"""Benchmark decontamination: an FM-index over each shard of training texts is searched for the test phrases.

A task builds the index over the words of some thousand texts; words that no test item has are separators. All phrases
(ten consecutive words of an item, or the whole of a shorter one) are searched together from their last words, their
occurrences are located from sampled suffix positions and merged to the spans of words to remove. No row is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, gathered, settled, spans, words_of
from .fm_index import FMIndex

WINDOW = 10
SHARD_CHARS = 1 << 20  # of the texts under one index, which takes about ninety bytes for each; a longer text has its own
PHRASE_BYTES = 1 << 24  # test texts whose phrases are sent to the tasks at a time

FOUND = "doc_id LONG, n_words LONG, n_hit LONG, items ARRAY<STRING>, spans ARRAY<STRUCT<first: LONG, last: LONG>>"


class Phrases:
    """The different windows of the items, by length, and the items that have each."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        names = sorted({name for name, _ in items if name is not None})
        number = {name: i for i, name in enumerate(names)}
        hashes, _, _, edges = words_of([text for _, text in items])
        self.names, self.words = names, np.unique(hashes)
        symbols = np.searchsorted(self.words, hashes) + 1
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for (name, _), a, b in zip(items, edges[:-1], edges[1:]):
            if b > a:
                length = min(window, b - a)
                rows = np.lib.stride_tricks.sliding_window_view(symbols[a:b], length)
                by_length.setdefault(length, []).append((rows, number.get(name, -1)))
        self.groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for parts in by_length.values():
            owners = np.repeat([i for _, i in parts], [len(rows) for rows, _ in parts])
            rows, back = np.unique(np.concatenate([rows for rows, _ in parts]), axis=0, return_inverse=True)
            back = back.reshape(-1)
            order = np.argsort(back, kind="stable")
            self.groups.append((rows, owners[order], spans(np.bincount(back, minlength=len(rows)))))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """1 and up for words of the items, 0 for others."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at + 1, 0)

    def find(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
        """Over one shard: which words are hit, the edges of the texts among the words, (text, item) pairs that occur,
        and the first and last + 1 bytes of the words in the joined texts."""
        hashes, starts, ends, edges = words_of(texts)
        # One separator before every text, and one at the end; runs of separators become one.
        owner = np.repeat(np.arange(len(texts)), np.diff(edges))
        line = np.zeros(len(hashes) + len(texts) + 1, np.int64)
        line[np.arange(len(hashes)) + owner + 1] = self.symbols(hashes)
        keep = line > 0
        keep[1:] |= line[:-1] > 0
        keep[0] = True
        places = np.flatnonzero(keep)
        index = FMIndex(line[places], len(self.words))
        cover = np.zeros(len(hashes) + 1, np.int64)
        pairs = [np.zeros((0, 2), np.int64)]
        text_starts = edges[:-1] + np.arange(len(texts)) + 1
        for rows, owners, bounds in self.groups:
            low, high = index.search(rows)
            counts = high - low
            if not counts.sum():
                continue
            phrase = np.repeat(np.arange(len(rows)), counts)
            at = places[index.locate(gathered(low, counts))]
            text = np.searchsorted(text_starts, at, "right") - 1
            word = at - text - 1
            np.add.at(cover, word, 1)
            np.add.at(cover, word + rows.shape[1], -1)
            # A phrase counts once for a text before its items are named, however often it stands there.
            text, phrase = np.divmod(np.unique(text * len(rows) + phrase), len(rows))
            n_items = np.diff(bounds)[phrase]
            pair = np.stack([np.repeat(text, n_items), owners[gathered(bounds[:-1][phrase], n_items)]], 1)
            pairs.append(np.unique(pair[pair[:, 1] >= 0], axis=0))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        return np.cumsum(cover[:-1]) > 0, edges, pairs, (starts, ends)


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last + 1 of each run of hits."""
    change = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return list(zip(change[0::2].tolist(), change[1::2].tolist()))


def _occurrences(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        for part in blocks(texts, SHARD_CHARS):
            hit, edges, pairs, _ = phrases.find(texts[part])
            running = spans(hit)
            n_hit = np.diff(running[edges])
            items = [[] for _ in texts[part]]
            runs = [[] for _ in texts[part]]
            for i in np.flatnonzero(n_hit).tolist():
                runs[i] = [{"first": a, "last": b} for a, b in _runs(hit[edges[i] : edges[i + 1]])]
            for text, item in pairs.tolist():
                items[text].append(phrases.names[item])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[part], pa.int64()), pa.array(np.diff(edges), pa.int64())]
                + [pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string()))]
                + [pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )


def _without(text: str, runs: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> str:
    """Without the words of the runs; starts and ends: the bytes of all words."""
    data = text.encode()
    kept, at = [], 0
    for first, last in runs:
        kept.append(data[at : starts[first]])
        at = int(ends[last - 1])
    return "\n".join(part.decode() for part in [*kept, data[at:]])


def _cut(text: str, phrases: Phrases) -> str:
    """Without the words in any occurrence; what a cut brings together is searched again until nothing is found."""
    while True:
        hit, _, _, (starts, ends) = phrases.find([text])
        if not hit.any():
            return text
        text = _without(text, _runs(hit), starts, ends)


def _cleaned(batches: Iterator[pa.RecordBatch], phrases: Phrases, at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(at).to_pylist()
        keep = np.ones(len(texts), bool)
        first = 0
        for part in blocks([t or "" for t in texts], SHARD_CHARS):
            hit, edges, _, _ = phrases.find([t or "" for t in texts[part]])
            found = np.diff(spans(hit)[edges])
            for i in np.flatnonzero(found).tolist():
                texts[first + i] = _cut(texts[first + i], phrases)
                keep[first + i] = len(words_of([texts[first + i]])[0]) > 0
            first += part.stop - part.start
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).filter(pa.array(keep))


def _merged(found: list[dict]) -> list[tuple[int, int]]:
    """Spans of several blocks of phrases as runs that do not touch."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted((x["first"], x["last"]) for x in found):
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(last, runs[-1][1]))
        else:
            runs.append((first, last))
    return runs


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of FOUND with the spans of several blocks as runs, and the number of words in them."""
    for batch in batches:
        runs = [_merged(found) for found in batch.column(4).to_pylist()]
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        columns = [batch.column(0), batch.column(1), pa.array([sum(b - a for a, b in own) for own in runs], pa.int64()), batch.column(3)]
        columns.append(pa.array([[{"first": a, "last": b} for a, b in own] for own in runs], kind))
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_hit", "items", "spans"])


def _apart(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Texts without the spans of the last column; those of which no word is left go."""
    for batch in batches:
        texts, found = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        for i, own in enumerate(found):
            _, starts, ends, _ = words_of([texts[i]])
            texts[i] = _without(texts[i], _merged(own), starts, ends)
        keep = [len(words_of([text])[0]) > 0 for text in texts]
        rest = batch.select(batch.schema.names[:-1])
        yield rest.set_column(at, rest.schema.field(at), pa.array(texts, rest.schema.field(at).type)).filter(pa.array(keep, pa.bool_()))


def _block_count(items: DataFrame) -> int:
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(-(-size // PHRASE_BYTES)) or 1


def phrase_blocks(bench: DataFrame, window: int = WINDOW) -> tuple[int, Iterator[Phrases]]:
    """The number of blocks, of a bounded number of bytes, and the phrases of each block's items, one block after the other."""
    items = bench.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = _block_count(items)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    chosen = (items.where(block == i) if n > 1 else items for i in range(n))
    return n, (Phrases([(r[0], r[1]) for r in rows.collect()], window) for rows in chosen)


def _block_by_block(rows: DataFrame, blocks_: Iterator[Phrases], all_: bool) -> DataFrame:
    """FOUND of rows (__row, text), with __row as doc_id; of all rows, or only of those with an occurrence.

    Each block's results are written before the next block is read, and united by __row.
    """
    both = None
    for phrases in blocks_:
        found = rows.select("__row", "text").mapInArrow(lambda batches, p=phrases: _occurrences(batches, p), FOUND)
        found = settled(found if all_ and both is None else found.where("n_hit > 0"), "found")
        both = found if both is None else both.union(found)
    united = both.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.sum("n_hit").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    return united.mapInArrow(_united, FOUND)


def occurrences(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, number of words, number of words inside any occurrence of a phrase, the items that occur, and
    the spans of such words (first, last + 1).

    Words are runs of digits, letters a to z after lower-casing A to Z, and all other non-ASCII characters. A null or
    empty text has no words. Items without words or without an item_id: the former match nothing, the latter mark words
    but are not listed. Rows that repeat a doc_id have a result each. Other columns are not read.

    More test texts than one block of phrases are searched block by block, and the results of each row united.
    """
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    n, found = phrase_blocks(bench, window)
    if n == 1:
        phrases = next(found)
        return rows.mapInArrow(lambda batches: _occurrences(batches, phrases), FOUND)
    rows = settled(rows.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    united = _block_by_block(rows, found, True).withColumnRenamed("doc_id", "__row")
    return united.join(rows.select("__row", "doc_id"), "__row").select("doc_id", "n_words", "n_hit", "items", "spans")


def decontaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with all columns, without the words inside any occurrence of a phrase; texts of which none is left go.

    What a cut brings together is searched again, for the phrases of all blocks, until nothing is found.
    """
    at = [name.lower() for name in docs.columns].index("text")
    n, found = phrase_blocks(bench, window)
    if n == 1:
        phrases = next(found)
        return docs.mapInArrow(lambda batches: _cleaned(batches, phrases, at), docs.schema)
    todo, done = settled(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed"), None
    while True:
        hits = _block_by_block(todo, found, False).select(F.col("doc_id").alias("__row"), F.col("spans").alias("__spans"))
        hits = settled(hits, "hits")
        clean = todo.join(hits, "__row", "left_anti").select(*docs.columns)
        done = clean if done is None else done.union(clean)
        if not hits.take(1):
            return done
        both = todo.join(hits, "__row").select(*docs.columns, "__row", "__spans")
        todo = settled(both.mapInArrow(lambda batches: _apart(batches, at), todo.schema), "cut")
        _, found = phrase_blocks(bench, window)
