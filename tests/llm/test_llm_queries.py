"""Registered queries against SQL or brute force at the smallest scale, and the pipeline stage by stage."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import differences, tables
from lumetry.llm import near_duplicates
from lumetry.llm.common import settled, table
from lumetry.llm.oracles import ORACLES
from lumetry.llm.tokens import encoder, public_path

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def groups(texts):
    """The smallest id reachable over texts of similarity 0.8 or more, by comparing all that share a shingle."""
    sets, owners, up = {i: shingles(t) for i, t in texts.items()}, defaultdict(list), {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(texts):
        for s in sets[i] or {(texts[i],)}:
            owners[s].append(i)
    for near in owners.values():
        for x in near[1:]:
            for y in near:
                if y == x:
                    break
                both = len(sets[x] & sets[y])
                if texts[x] == texts[y] or both >= 0.8 * (len(sets[x]) + len(sets[y]) - both) > 0:
                    a, b = sorted((root(x), root(y)))
                    up[b] = a
    return {i: root(i) for i in texts}


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, FOLDER, "documents").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    assert differences(entry.queries()[name](spark, FOLDER), tables(FOLDER), ORACLES[name]) == []


def test_token_files_and_packing(spark, docs):
    model = encoder(public_path()).model
    ids = {i: np.array(model.encode(docs[i] or "", add_special_tokens=False).ids + [0], "<u4") for i in sorted(docs)}
    rows = entry.queries()["op9_token_files"](spark, FOLDER).collect()
    at, want = 0, []
    for i, own in ids.items():
        want.append((i, at, len(own), zlib.crc32(own), int(own[0]), int(own[len(own) // 2])))
        at += len(own)
    assert sorted(tuple(r) for r in rows) == want
    sizes, reached = defaultdict(list), Counter()
    for r in sorted(entry.queries()["op1_retrieval_packing"](spark, FOLDER).collect(), key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == reached[r["doc_id"]] and r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]])
        reached[r["doc_id"]] += r["length"]
        sizes[r["sequence_id"]].append((r["offset"], r["length"]))
    assert reached == {i: len(own) for i, own in ids.items()}
    for pieces in sizes.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == 1024 or end & (end - 1) == 0


@pytest.mark.parametrize("bucket", [4096, 3])
def test_near_duplicates(spark, docs, bucket):
    found = near_duplicates.near_duplicates(table(spark, FOLDER, "documents"), bucket=bucket)
    assert {r["doc_id"]: r["group_id"] for r in found.collect()} == groups({i: t or "" for i, t in docs.items()})


def test_quality(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    rows = entry.queries()["op4_quality_classifier"](spark, FOLDER).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    known = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    low, high = ([s for s, label in known if label == k] for k in (0, 1))
    assert np.mean([a < b for a in low for b in high]) > 0.9


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = settled(stage(spark, docs, FOLDER), name)
        assert docs.columns == before.columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = {r["doc_id"]: r["text"] for r in table(spark, FOLDER, "documents").collect()}
    good = [i for i in first if labels.get(i) == 1]
    assert len(set(good) & kept["quality"].keys()) > 0.97 * len(good)
    roots = groups({i: t or "" for i, t in kept["quality"].items()})
    assert kept["near_duplicates"].keys() == set(roots.values())
    seen = set()
    for i in sorted(kept["substrings"]):
        w = kept["substrings"][i].split()
        own = {" ".join(w[k : k + 60]) for k in range(len(w) - 59)}
        assert not own & seen
        seen |= own
    phrases = {tuple(w[k : k + 10]) for r in table(spark, FOLDER, "benchmark").collect() for w in [words(r["text"])] for k in range(max(1, len(w) - 9))}
    for text in kept["decontamination"].values():
        w = words(text)
        assert not any(tuple(w[k : k + 10]) in phrases for k in range(len(w)))
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in pieces} == kept["decontamination"].keys()
