"""What near-duplicate search moves grows with the members of a group, and misses no pair that ties them together."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lumetry.llm import near_duplicates as nd


def variants(n, changed=4, words=300, seed=1):
    """Texts of one template, of which most pairs have a similarity between 0.68 and 0.8."""
    chance = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    texts = []
    for k in range(n):
        own = list(base)
        for slot in chance.sample(range(2, words, 6), changed):
            own[slot] = f"v{k}x{slot}"
        texts.append(" ".join(own))
    return texts


def bucket(texts):
    """One bucket with all of them, each in a component of its own."""
    elements, weights, edges = nd.shingles(texts)
    prints = nd.signatures(elements, weights, edges)
    n = len(texts)
    columns = [pa.array(x) for x in (np.zeros(n, np.int64), np.zeros(n, np.int32), np.arange(n), np.arange(n), np.zeros(n, np.int32))]
    columns += [pa.array([p.tobytes() for p in prints], pa.binary()), pa.array(texts)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "band", "id", "component", "side", "prints", "text"])


def roots(n, links):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        up[high] = low
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("n", [100, 200, 400])
def test_links_of_a_bucket_are_a_forest(n):
    batch = bucket(variants(n))
    least = nd.least_estimate(nd.SIMILARITY)
    some = sum(b.num_rows for b in nd._involved(iter([batch.select(range(6))]), least))
    links = [p for b in nd._joined(iter([batch]), nd.WORDS, False, nd.SIMILARITY, least) for p in zip(*(c.to_pylist() for c in b.columns))]
    assert some <= n and len(links) < n
    elements, weights, edges = nd.shingles(batch.column(6).to_pylist())
    sets = [set(elements[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:])]
    pairs = [(i, j) for i in range(n) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert 0 < len(pairs) < 0.3 * n * (n - 1) / 2
    assert roots(n, links) == roots(n, pairs)


def test_batches_do_not_part_buckets():
    """Rows of a bucket may come in several batches, as may several buckets in one."""
    one = bucket(variants(30))
    two = one.set_column(0, "key", pa.array(np.ones(30, np.int64)))
    whole = pa.Table.from_batches([one, two]).combine_chunks().to_batches()[0]
    least = nd.least_estimate(nd.SIMILARITY)

    def links(batches):
        found = nd._joined(iter(batches), nd.WORDS, False, nd.SIMILARITY, least)
        return [p for b in found for p in zip(*(c.to_pylist() for c in b.columns))]

    assert links([whole]) == links([whole.slice(k, 7) for k in range(0, 60, 7)])


def test_groups_of_many_variants(spark):
    texts = variants(120, seed=3) + ["another text altogether " + " ".join(f"z{i}" for i in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    elements, _, edges = nd.shingles(texts)
    sets = [set(elements[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:])]
    pairs = [(i, j) for i in range(121) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = dict(enumerate(roots(121, pairs)))
    for size in (4096, 20):
        found = nd.near_duplicates(docs, bucket=size).collect()
        assert {r["doc_id"]: r["group_id"] for r in found} == want
