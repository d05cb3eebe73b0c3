"""A quality classifier with supervised subword embeddings.

Every word and every character n-gram of a text is hashed to a learned vector; the mean of a text's vectors goes through
a softmax layer. Vectors and layer are trained together by stochastic gradient descent in numpy, on a sample of labelled
texts of bounded number. The layer is linear, so for scoring each bucket's vector is folded into one number, and a
text's score is the logistic function of a mean: one pass over the text, whatever the size of the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, blocks, digest, span_hashes

BUCKETS = 1 << 17
SIZES = (2, 3, 4)  # characters in an n-gram
DIM = 12
EPOCHS = 6
RATE = 4.0
SAMPLE = 5000  # labelled texts to learn from, at most
BLOCK = 1 << 18  # characters handled at a time
THRESHOLD = 0.3  # a text with a lower score is rejected
REPEATED = 0  # the bucket of a word that equals the one before it

FEATURES = "doc_id LONG, label INT, buckets BINARY, counts BINARY"


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words and n-grams of the texts, and the text that each of them is from.

    N-grams stay inside a word with one mark on either side. A word that repeats the one before it adds one fixed bucket.
    """
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = " " + "".join(text + " " for text in texts)
    symbols = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    blank = (symbols <= 32) | (symbols == 0xA0)
    symbols = np.where(blank, np.uint32(32), symbols)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text_at = np.append(np.repeat(np.arange(len(texts)), sizes), len(texts) - 1)
    change = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = change[0::2], change[1::2]
    words = span_hashes(symbols, starts, ends)
    places, buckets = [starts], [1 + (words >> U64(40)).astype(np.int64) % (BUCKETS - 1)]
    again = np.flatnonzero(words[1:] == words[:-1]) + 1
    again = again[text_at[starts[again]] == text_at[starts[again - 1]]]
    for _ in range(4):  # as heavy as the n-grams of a short word
        places.append(starts[again])
        buckets.append(np.full(len(again), REPEATED))
    key = np.zeros(len(symbols), np.uint32)
    for n in range(1, max(SIZES) + 1):
        key = key[: len(symbols) - n + 1] * np.uint32(0x01000193) + symbols[n - 1 :]
        if n not in SIZES:
            continue
        inner = np.zeros(len(key), bool)
        for j in range(1, n - 1):
            inner |= blank[j : j + len(key)]
        ok = np.flatnonzero(~inner & ~(blank[: len(key)] & blank[n - 1 :]))
        mixed = (key[ok] ^ np.uint32(n * 0x3D4D51CB)) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
        places.append(ok)
        buckets.append(1 + (mixed % np.uint32(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(buckets), text_at[np.concatenate(places)]


def text_sums(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sum of table[bucket] over its features, and their number."""
    sums, counts = [np.zeros(0)], [np.zeros(0, np.int64)]
    for part in blocks(texts, BLOCK):
        buckets, owners = features(texts[part])
        n = part.stop - part.start
        sums.append(np.bincount(owners, table[buckets], n))
        counts.append(np.bincount(owners, minlength=n))
    return np.concatenate(sums), np.concatenate(counts)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Learn from (label, buckets, counts) rows; returns each bucket's share in the logit, and the logit without any."""
    labels = np.array([r[0] for r in rows], np.int64)
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)  # of label 1
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), prior
    random = np.random.default_rng(7)
    vectors = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer = random.normal(0, 0.1, (DIM, 2))
    bias = np.array([0.0, prior])
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)).tolist():
            label, buckets, counts = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            if not len(buckets):
                continue
            weights = counts / counts.sum()
            hidden = weights @ vectors[buckets]
            logits = hidden @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            layer -= 0.1 * rate * np.outer(hidden, error)
            bias -= 0.02 * rate * error
            vectors[buckets] -= rate * weights[:, None] * back
    fold = layer[:, 1] - layer[:, 0]
    return (vectors @ fold).astype(np.float32), float(bias[1] - bias[0])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        ids, labels = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for part in blocks(texts, BLOCK):
            buckets, owners = features(texts[part])
            keys, tf = np.unique(owners * BUCKETS + buckets, return_counts=True)
            edges = np.searchsorted(keys, np.arange(part.stop - part.start + 1) * BUCKETS)
            found = [(keys[a:b] % BUCKETS, tf[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids[part], pa.int64()),
                    "label": pa.array(labels[part], pa.int32()),
                    "buckets": [b.astype("<i4").tobytes() for b, _ in found],
                    "counts": [c.astype("<f4").tobytes() for _, c in found],
                }
            )


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for row in batch.to_pylist():
            pair = np.frombuffer(row["buckets"], "<i4"), np.frombuffer(row["counts"], "<f4")
            rows.append((row["doc_id"], row["label"], *pair))
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))  # not the order in which tasks ended
    table, bias = train([r[1:] for r in rows])
    yield pa.RecordBatch.from_pydict({"shares": [table.tobytes()], "bias": [bias]})


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """The model, from labelled documents that are not held out.

    At most `sample` of them are used, those whose doc_id hashes lowest, so their number does not grow with the data;
    one task trains on them, and only the model comes to the driver. Labels other than 0 and 1 and null doc_ids are not
    used; of several labels of a document the lowest counts. Without labels every score is 0.5; with labels of one kind
    alone every score leans that way.
    """
    chosen = (
        labels.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(quality AS INT) AS label")
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "coalesce(text, '') AS text")
    joined = texts.join(F.broadcast(chosen), "doc_id")  # `chosen` has at most `sample` rows
    # One row for each of them, however often its doc_id is repeated: that with the text of the lowest digest.
    first = F.min(F.struct(digest("text").alias("digest"), "text")).alias("first")
    joined = joined.groupBy("doc_id", "label").agg(first).select("doc_id", "first.text", "label")
    counted = joined.mapInArrow(_counted, FEATURES)
    row = counted.repartition(1).mapInArrow(_trained, "shares BINARY, bias DOUBLE").first()
    return np.frombuffer(row["shares"], np.float32), row["bias"]


def _scored(batches: Iterator[pa.RecordBatch], table: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        if not texts:
            continue
        sums, counts = text_sums(texts, table)
        logits = np.clip(bias + sums / np.maximum(counts, 1), -30, 30)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(1 / (1 + np.exp(-logits)), pa.float64())})


def scores(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id and score of every row: 0 to 1, higher where label 1 is likelier. Whole texts; null counts as empty."""
    chosen = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    return chosen.mapInArrow(lambda batches: _scored(batches, *model), "doc_id LONG, score DOUBLE")


def accepted(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score is at least `threshold`."""
    at = [name.lower() for name in docs.columns].index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, counts = text_sums([t or "" for t in batch.column(at).to_pylist()], model[0])
            logits = model[1] + sums / np.maximum(counts, 1)
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(logits, -30, 30))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
