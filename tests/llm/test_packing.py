"""Neighbours are those of a plain BM25 over all documents, wherever they stand."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from lumetry.llm import packing
from lumetry.llm.common import words_of

from .conftest import WORDS


def bm25(texts, seed, other):
    """The score of a text for the words of another, by the book."""
    split = [t.split() for t in texts]
    n, mean = len(texts), sum(map(len, split)) / len(texts)
    score, tf = 0.0, Counter(split[other])
    for word in set(split[seed]):
        df = sum(word in s for s in split)
        idf = max(math.log((n - df + 0.5) / (df + 0.5)), 0)
        if tf[word]:
            norm = packing.K1 * (1 - packing.B + packing.B * len(split[other]) / mean)
            score += idf * tf[word] * (packing.K1 + 1) / (tf[word] + norm)
    return score


def some_texts(n, seed=4):
    chance = random.Random(seed)
    words = [f"{w}{i}" for w in WORDS for i in range(12)]
    return [" ".join(chance.choice(words) for _ in range(chance.randint(5, 60))) for _ in range(n)]


def known_of(spark, texts):
    return packing.statistics(spark.createDataFrame([(t,) for t in texts], "text STRING").repartition(5))


def test_statistics_are_those_of_all_documents(spark):
    texts = some_texts(70)
    known = known_of(spark, texts)
    assert known.n == 70 and known.mean == sum(len(t.split()) for t in texts) / 70
    assert known.frequencies.sum() == sum(len(set(t.split())) for t in texts)


def test_scores(spark):
    texts = some_texts(60)
    known = known_of(spark, texts)
    shard = texts[10:40]  # the weights are those of all, whatever the shard holds
    index = packing.Index(shard, known)
    for seed in range(0, 30, 7):
        scores = index.scores(seed)
        for other in range(30):
            if other != seed:
                assert abs(scores[other] - bm25(texts, seed + 10, other + 10)) < 1e-9


def test_a_window_is_filled_with_the_best_unused_neighbours(spark):
    texts = some_texts(40)
    known = known_of(spark, texts)
    packer = packing.Packer(100, 0)
    packer.add([(i, np.full(30, i, np.uint32)) for i in range(40)], packing.Index(texts, known))
    packer.close()
    order = list(dict.fromkeys(p[0] for p in packer.pieces))
    unused, filled, at, seed = set(range(40)), 0, 0, None
    while unused:
        now = min(unused) if seed is None else max(unused, key=lambda i: (round(bm25(texts, seed, i), 9), -i))
        assert order[at] == now
        unused.discard(now)
        before, filled, at = filled, filled + 30, at + 1
        if filled % 100 == 0:
            seed = None
        elif seed is None or filled // 100 != before // 100:
            seed = now


def test_relatives_meet_wherever_they_stand(spark):
    """Pairs that share a word which nobody else has, in a table of many files and more tasks than rows in each."""
    chance = random.Random(1)
    common = [f"common{i}" for i in range(30)]
    rows = []
    for i in range(60):
        for side in range(2):
            words = [chance.choice(common) for _ in range(40)]
            words[chance.randrange(40)] = f"family{i}"
            rows.append((1000 * side + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(30, "doc_id")
    found = packing.pack(docs, window=4096).collect()
    places = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        places.setdefault(r["doc_id"], len(places))
    next_door = sum(abs(places[i] - places[1000 + i]) == 1 for i in range(60))
    assert next_door >= 55  # a pair that a task's last window would part may stand elsewhere


def test_a_word_of_many_documents_gets_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 10)
    docs = spark.createDataFrame([(i, "the same words again and again") for i in range(200)], "doc_id LONG, text STRING")
    known = packing.statistics(docs)

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr(packing, "TaskContext", Context)
    (batch,) = docs.toArrow().combine_chunks().to_batches()
    (routed,) = packing._routed(iter([batch]), known)
    assert set(Counter(routed.column(3).to_pylist()).values()) == {10} and len(set(routed.column(2).to_pylist())) == 1


def test_words_are_hashed_a_block_at_a_time(monkeypatch):
    """Their arrays hold some tens of bytes for each character, so a whole shard of them is much of a worker's memory."""
    sizes = []

    def counted(texts):
        sizes.append(sum(map(len, texts)))
        return words_of(texts)

    texts = [*some_texts(1500), "", "x " * 50_000]
    whole = words_of(texts)
    monkeypatch.setattr(packing, "words_of", counted)
    known = packing.Statistics(len(texts), 60.0, np.full(packing.BUCKETS, 2, np.int32))
    index = packing.Index(texts, known)
    assert sum(sizes) == sum(map(len, texts)) > packing.BLOCK >= max(sizes)
    hashes, lengths = packing._words(texts)
    assert (hashes == whole[0]).all() and (lengths == np.diff(whole[3])).all() and index.n == len(texts)


def test_document_frequencies_count_a_text_once_for_a_word():
    texts = [*some_texts(1500), None, "", "again again again", "again"]
    counted = list(packing._counts(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})])))
    found = dict(zip(counted[0].column(0).to_pylist(), counted[0].column(1).to_pylist()))
    expected = Counter()
    for text in texts:
        expected.update(set(packing.bucket_of(words_of([text or ""])[0]).tolist()))
    words = sum(len((text or "").split()) for text in texts)
    assert found == {**expected, -1: len(texts), -2: words}
