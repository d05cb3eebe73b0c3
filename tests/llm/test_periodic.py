"""Runs of words against a search of every period."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as entry
from lumetry.llm import periodic
from lumetry.llm.common import table

from .conftest import prose

FOLDER = "/root/testdata/sf0.001"


def runs(words, least=12):
    """(start, length, period) of all runs, by comparing the words of every distance."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((start, length, p) for (start, length), p in found.items())


def collapsed(words):
    gone = set()
    for start, length, p in runs(words):
        gone.update(range(start + p, start + length))
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("pairs", [50, 1 << 20])
def test_maximal_runs(monkeypatch, pairs):
    monkeypatch.setattr(periodic, "PAIRS", pairs)
    chance = random.Random(3)
    for _ in range(120):
        texts = []
        for _ in range(chance.randint(1, 6)):
            n = chance.choice([0, 1, 11, 12, 13, 40, 250])
            own = [chance.randrange(chance.choice([1, 2, 3, 40])) for _ in range(n)]
            if n and chance.random() < 0.5:
                a = chance.randrange(n)
                p = 1 + (n - a) // chance.randint(3, 10)
                own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
            texts.append(own)
        sizes = np.array([len(t) for t in texts])
        of, start, length, period = periodic.maximal_runs(np.array(sum(texts, []), np.uint32), sizes)
        found = [[] for _ in texts]
        for i, *run in zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()):
            found[i].append(tuple(run))
        assert found == [runs(t) for t in texts]


def test_extensions():
    chance = np.random.default_rng(5)
    symbols = np.append(chance.integers(0, 2, 400), 7).astype(np.uint32)
    symbols[200:300] = symbols[50:150]
    extend = periodic.Extensions(symbols)
    i, j = (x[chance.integers(0, 401, 3000)] for x in (np.arange(401),) * 2)
    i, j = i[i != j], j[i != j]
    for a, b, n in zip(i.tolist(), j.tolist(), extend(i, j).tolist()):
        k = 0
        while symbols[a + k] == symbols[b + k]:
            k += 1
        assert n == k


def test_awkward(spark, awkward, nothing):
    rows = periodic.periodic_runs(awkward).collect()
    assert len(rows) == 13 and {r["n_words"] for r in rows if r["doc_id"] in (4, 5)} == {0}
    assert {(tuple(r["runs"]), r["collapsed"]) for r in rows if r["doc_id"] in (4, 5)} == {((), "")}
    assert [r["collapsed"] for r in rows if r["doc_id"] == 10] == ["é ü 中文 \u00a0 ×"]
    long = next(r for r in rows if r["doc_id"] == 6)
    words = prose(3, 30000).split()
    q = next(p for p in range(1, 15000) if words[p:] == words[:-p])
    assert [tuple(r) for r in long["runs"]] == [(0, 30000, q)] and long["collapsed"] == " ".join(words[:q])
    assert periodic.periodic_runs(nothing).count() == 0


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, FOLDER, "documents").collect()}
    rows = {r["doc_id"]: r for r in entry.queries()["op11_periodic_runs"](spark, FOLDER).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        words = periodic.WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        want, row = runs(words), rows[i]
        assert row["n_runs"] == len(want)
        assert row["runs_sha256"] == sha256("".join(f"{s},{l},{p}\n" for s, l, p in want).encode()).hexdigest()
        assert row["collapsed_sha256"] == sha256(collapsed(words).encode()).hexdigest()
        top = max(want, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        given = (row["start"], row["length"], row["period"], row["exponent_milli"])
        assert given == ((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
