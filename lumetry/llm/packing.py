"""Lexical retrieval packing: windows of tokens filled with documents that share rare words.

The weights of words, their document frequencies and the mean length, are those of all documents. Every document is then
routed by the rarest word that it shares with another, so documents that have such a word in common meet, wherever they
stand; a word that very many are routed by gets as many shares as it takes. Each task builds a BM25 inverted index over one
shard after the other of the documents that it gets, a few thousand in the order of their words. A window starts with a
seed: the rest of the document that the last window cut, or else the first unused one. The index returns the seed's unused
neighbours, best first, and they fill the window; the last is cut where the window ends.

Document frequencies are counted in BUCKETS counters, by a hash of the word: exactly, while words are few beside them, and
beyond that a word has the frequency of all that share its counter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, blocks, gathered, mix, partitions, spans, words_of
from .tokens import encode_with_end

WINDOW = 1024
SHARD_DOCS = 1 << 13
SHARD_CHARS = 1 << 22  # a shard ends at either bound; a longer text is a shard of its own
BUCKETS = 1 << 21  # counters of document frequencies: 8 MB, however many documents there are
BLOCK = 1 << 17  # characters whose words are hashed at a time: the arrays, of eight bytes for each, stay in a core's cache
RAREST = (1 << 31) - 1  # frequencies from here on are alike when a document is routed
NO_WORD = U64(2**64 - 1)
K1, B = 1.2, 0.75

PIECES = (
    "doc_id LONG, start LONG, length LONG, ids_crc32 LONG, doc_tokens LONG, sequence_id LONG, offset LONG, ids ARRAY<INT>"
)


class Statistics(NamedTuple):
    """Of all documents: how many there are, their mean number of words, and the document frequencies by bucket."""

    n: int
    mean: float
    frequencies: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.frequencies[bucket_of(hashes)].astype(np.int64)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, one after the other, and each text's number of words."""
    found = [words_of(texts[part]) for part in blocks(texts, BLOCK)]
    return np.concatenate([hashes for hashes, *_ in found]), np.concatenate([np.diff(edges) for *_, edges in found])


class Index:
    """A BM25 inverted index over some thousand texts, of the words that at most half of all documents have.

    The others would weigh nothing: their inverse document frequency is not positive.
    """

    def __init__(self, texts: list[str], known: Statistics):
        hashes, lengths = _words(texts)
        n = len(texts)
        # Words in the order of their hashes, and of their texts among equal ones.
        order = np.argsort(hashes)
        ordered = hashes[order]
        new_word = np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]
        keys = (np.cumsum(new_word) - 1) * n + np.repeat(np.arange(n), lengths)[order]
        keys.sort()
        at = np.flatnonzero(np.diff(keys, prepend=-1))
        tf, (term, doc) = np.diff(np.append(at, len(keys))), np.divmod(keys[at], n)
        words = ordered[new_word]
        df = np.minimum(known.of(words), known.n)
        idf = np.maximum(np.log((known.n - df + 0.5) / (df + 0.5)), 0.0)
        norm = K1 * (1 - B + B * lengths / max(known.mean, 1.0))
        weights = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        keep = (weights > 0) & (np.bincount(term, minlength=len(words))[term] > 1)  # words of one text find no other
        self.doc, self.weights, term = doc[keep], weights[keep], term[keep]
        self.starts = np.searchsorted(term, np.arange(len(words)))
        self.counts = np.bincount(term, minlength=len(words))
        order = np.argsort(self.doc, kind="stable")
        self.terms, self.edges, self.n = term[order], spans(np.bincount(self.doc, minlength=n)), n

    def scores(self, seed: int) -> np.ndarray:
        """Of every text for the words of the seed."""
        terms = self.terms[self.edges[seed] : self.edges[seed + 1]]
        at = gathered(self.starts[terms], self.counts[terms])
        return np.bincount(self.doc[at], self.weights[at], minlength=self.n)


class Packer:
    """Fills windows with one shard after the other."""

    def __init__(self, window: int, first_id: int):
        self.window, self.sequence, self.filled = window, first_id, 0
        self.pieces: list[tuple] = []

    def _place(self, doc: tuple, start: int) -> int:
        """Put as much of the document from `start` on as fits; returns where it was cut or ended."""
        doc_id, ids = doc
        end = min(len(ids), start + self.window - self.filled)
        self.pieces.append((doc_id, start, ids[start:end], len(ids), self.sequence, self.filled))
        self.filled += end - start
        if self.filled == self.window:
            self.sequence, self.filled = self.sequence + 1, 0
        return end

    def add(self, docs: list[tuple], index: Index) -> None:
        unused = np.ones(len(docs), bool)
        scores, first = None, 0
        while unused.any():
            if scores is None:
                first += int(unused[first:].argmax())
                now = first
            else:
                now = int(np.where(unused, scores, -1.0).argmax())
            unused[now] = False
            here, start = self.sequence, self._place(docs[now], 0)
            while start < len(docs[now][1]):
                start = self._place(docs[now], start)
            if self.filled == 0:
                scores = None  # the window is full, and a new seed starts the next one
            elif scores is None or self.sequence != here:
                scores = index.scores(now)  # this document is the seed of the window that is open now

    def close(self) -> None:
        """Cut the last window at powers of two, so that it needs no padding either."""
        if not self.filled:
            return
        tail, self.pieces[:] = [p for p in self.pieces if p[4] == self.sequence], [p for p in self.pieces if p[4] != self.sequence]
        sizes = [1 << b for b in range(self.filled.bit_length() - 1, -1, -1) if self.filled >> b & 1]
        room, at = sizes.pop(0), 0
        for doc_id, start, ids, n, _, _ in tail:
            while len(ids):
                now = ids[: room - at]
                self.pieces.append((doc_id, start, now, n, self.sequence, at))
                ids, start, at = ids[len(now) :], start + len(now), at + len(now)
                if at == room and (sizes or len(ids)):
                    self.sequence, room, at = self.sequence + 1, sizes.pop(0), 0
        self.sequence, self.filled = self.sequence + 1, 0

    def taken(self, all_: bool, with_ids: bool) -> pa.RecordBatch | None:
        """The pieces of finished windows."""
        done = [p for p in self.pieces if all_ or p[4] != self.sequence]
        self.pieces = [] if all_ else [p for p in self.pieces if p[4] == self.sequence]
        if not done:
            return None
        doc_ids, starts, ids, totals, sequences, offsets = zip(*done)
        crcs = [zlib.crc32(x.astype("<u4")) for x in ids]
        lengths = [len(x) for x in ids]
        columns = [pa.array(x, pa.int64()) for x in (doc_ids, starts, lengths, crcs, totals, sequences, offsets)]
        if with_ids:
            edges = pa.array(spans(np.array(lengths)), pa.int32())
            lists = pa.ListArray.from_arrays(edges, pa.array(np.concatenate(ids).astype(np.int32)))
        else:
            lists = pa.nulls(len(ids), pa.list_(pa.int32()))
        names = [field.split()[0] for field in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([*columns, lists], names=names)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, chars = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            if texts and (len(texts) >= SHARD_DOCS or chars + len(text) > SHARD_CHARS):
                yield ids, texts
                ids, texts, chars = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            chars += len(text)
    if texts:
        yield ids, texts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, n) of this task's texts: documents that have a word of the bucket; for -1 documents, for -2 words."""
    counts, documents, words = np.zeros(BUCKETS, np.int64), 0, 0
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        for part in blocks(texts, BLOCK):
            hashes, _, _, edges = words_of(texts[part])
            keys = np.repeat(np.arange(len(edges) - 1), np.diff(edges)) * BUCKETS
            keys += bucket_of(hashes)
            keys.sort()
            np.add.at(counts, keys[np.diff(keys, prepend=-1) != 0] % BUCKETS, 1)
            documents, words = documents + len(edges) - 1, words + len(hashes)
    some = np.flatnonzero(counts)
    columns = [np.append(some, [-1, -2]), np.append(counts[some], [documents, words])]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "n"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most BUCKETS + 2 rows (bucket, n) as one."""
    frequencies, n, words = np.zeros(BUCKETS, np.int64), 0, 0
    for batch in batches:
        bucket, count = (batch.column(i).to_numpy() for i in (0, 1))
        inside = bucket >= 0
        frequencies[bucket[inside]] = count[inside]
        n += int(count[bucket == -1].sum())
        words += int(count[bucket == -2].sum())
    held = np.minimum(frequencies, np.iinfo(np.int32).max).astype("<i4").tobytes()
    yield pa.RecordBatch.from_pydict({"n": [n], "words": [words], "frequencies": [held]})


def statistics(docs: DataFrame) -> Statistics:
    """Of all documents. What comes to the driver has the size of BUCKETS counters."""
    counted = docs.select("text").mapInArrow(_counts, "bucket LONG, n LONG").groupBy("bucket").agg(F.sum("n").alias("n"))
    row = counted.repartition(1).mapInArrow(_gathered, "n LONG, words LONG, frequencies BINARY").first()
    if row is None:  # a table without rows may have no task either
        return Statistics(0, 0.0, np.zeros(BUCKETS, np.int32))
    return Statistics(row["n"], row["words"] / max(row["n"], 1), np.frombuffer(row["frequencies"], "<i4"))


def _routed(batches: Iterator[pa.RecordBatch], known: Statistics) -> Iterator[pa.RecordBatch]:
    """The rows with their rarest shared word, and the share of that word's documents that they go to."""
    before = 0
    for batch in batches:
        column = batch.column(1).fill_null("")
        texts = column.to_pylist()
        word, share = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for part in blocks(texts, BLOCK):
            hashes, _, _, edges = words_of(texts[part])
            df = known.of(hashes)
            # The least of these numbers is the rarest shared word of a text, and among equally rare ones the same for all.
            keys = np.minimum(df, RAREST).astype(U64) << U64(64 - RAREST.bit_length()) | hashes >> U64(RAREST.bit_length())
            keys[df < 2] = NO_WORD
            least = np.minimum.reduceat(np.append(keys, NO_WORD), edges[:-1])
            least[np.diff(edges) == 0] = NO_WORD
            own = np.flatnonzero(least != NO_WORD)
            at = part.start + own
            word[at] = least[own].view(np.int64)
            # Rows of one word are dealt out in turn, each task beginning where its number says.
            rows = least[own] >> U64(64 - RAREST.bit_length())
            share[at] = (before + at + TaskContext.get().partitionId() * 7919) % -(-rows.astype(np.int64) // SHARD_DOCS)
            alone = np.setdiff1d(np.arange(part.start, part.stop), at)
            word[alone] = mix(alone + before).view(np.int64)  # a text without a shared word goes anywhere
        before += len(texts)
        columns = [batch.column(0), column, pa.array(word), pa.array(share)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "word", "share"])


def _packed(
    batches: Iterator[pa.RecordBatch], known: Statistics, window: int, path: str | None, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    packer = Packer(window, TaskContext.get().partitionId() << 40)
    for doc_ids, texts in _shards(batches):
        flat, counts = encode_with_end(texts, path)
        edges = spans(counts)
        docs = [(d, flat[a:b]) for d, a, b in zip(doc_ids, edges[:-1], edges[1:])]
        packer.add(docs, Index(texts, known))
        if (out := packer.taken(False, with_ids)) is not None:
            yield out
    packer.close()
    if (out := packer.taken(True, with_ids)) is not None:
        yield out


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pack all documents into sequences of `window` ids; one row per piece.

    A row: doc_id; start, the number of the document's ids before the piece; length; ids_crc32 of the piece's ids as
    little-endian unsigned 32-bit integers; doc_tokens, all ids of the document with its end id; sequence_id; offset in
    the sequence, gapless from 0; ids (null unless with_ids).

    Every sequence is full but for the last few of each task, which are cut at powers of two. A null or empty text is
    the end id alone. Rows that repeat a doc_id are packed each; a null doc_id stays null. An empty table gives no rows.
    Equal scores go to the earlier row. Columns other than doc_id and text are not read.
    """
    chosen = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    known = statistics(chosen)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    routed = chosen.mapInArrow(lambda b: _routed(b, shared.value), "doc_id LONG, text STRING, word LONG, share LONG")
    dealt = routed.repartition(partitions(docs), "word", "share").sortWithinPartitions("word", "share", "doc_id")
    return dealt.select("doc_id", "text").mapInArrow(lambda b: _packed(b, shared.value, window, tokenizer, with_ids), PIECES)
