"""The trie of rebuilt conversations against one built of whole texts."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np

import __spark_entry__ as entry
from lumetry.llm import prefix_trie
from lumetry.llm.common import table

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rows):
    """Rows (conv_id, turn, role, text) to the nodes' rows."""
    own = {}
    for conv, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    below = {n: [0, 0] for n in nodes}
    children = {n: 0 for n in nodes}
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    for n, members in nodes.items():
        saved = (len(members) - 1) * len(WORD.findall(n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            below[n[:d]][0] += not children[n]
            below[n[:d]][1] += saved
    found = []
    for n, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(rebuilt[c]) == len(n)))
        parent = min(nodes[n[:-1]]) if n else None
        found.append((min(members), len(n), parent, len(members), children[n], *below[n], sha256(ends.encode()).hexdigest()))
    return sorted(found)


def result(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def frame_of(spark, rows):
    kinds = "conv_id LONG, turn LONG, role STRING, text STRING, depth STRING, f1 STRING, ref STRING, k STRING, parent STRING"
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], kinds)


def chance_rows(seed, convs, longest):
    chance, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(chance.choice([1, 2, 3, longest])):
            rows.append((c, t if t else None, chance.choice(["user", "bot", None]), chance.choice(["a", "b c", "", None])))
    return rows


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "partitions", lambda df: 7)
    rows = chance_rows(7, 150, 9) + [(None, 1, "user", "left out"), (203, 0, None, None)]
    # One conversation that is longer than all others, and a copy of most of it, so that some tasks read nothing else.
    rows += [(207, t, "user", f"long {t % 5} {t}") for t in range(700)] + [(208, t, "user", f"long {t % 5} {t}") for t in range(600)]
    # And one that repeats turns, with the same turn number as well.
    rows += [(211, 3, "user", "again")] * 5 + [(211, 2, "user", "again")]
    random.Random(1).shuffle(rows)
    assert result(prefix_trie.prefix_trie(frame_of(spark, rows).repartition(5))) == trie(rows)


def test_stored_turns(spark):
    """Each node names a stored turn that holds its last text."""
    rows = [r for r in chance_rows(5, 60, 6) if r[0] % 7]
    places, turns = {}, {}
    for conv, _, _, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        places[conv] = places.get(conv, 0) + 1
        turns[conv, places[conv]] = text
    for r in prefix_trie.prefix_trie(frame_of(spark, rows)).collect():
        assert (r["depth"] == 0) == (r["text_conv_id"] is None) == (r["text_turn"] is None)
        assert r["depth"] == 0 or (r["text_conv_id"], r["text_turn"]) in turns


def test_chance_collisions(spark, monkeypatch):
    """Fingerprints that coincide are noticed, and others used."""
    real = prefix_trie.bases
    monkeypatch.setattr(prefix_trie, "bases", lambda seed: real(seed) if seed else (1, 1))  # sums: the order is lost
    rows = [(21, 0, "user", "a"), (21, 1, "user", "b"), (21, 2, "user", "c"), (21, 3, "user", "d")]
    rows += [(22, 0, "user", "b"), (22, 1, "user", "a"), (22, 2, "user", "d"), (22, 3, "user", "c")]
    rows = [(c + 20 * k, *rest) for k in range(4) for c, *rest in rows]
    assert result(prefix_trie.prefix_trie(frame_of(spark, rows))) == trie(rows)


def test_fingerprints_compose():
    chance = np.random.default_rng(2)
    turns = chance.integers(0, prefix_trie.PRIME, 50).astype(np.uint64)
    (base, _) = prefix_trie.bases(0)
    place = np.concatenate([np.arange(1, 31), np.arange(1, 21)])
    want, now = [], 0
    for turn, at in zip(turns.tolist(), place.tolist()):
        now = ((0 if at == 1 else now) * base + turn) % prefix_trie.PRIME
        want.append(now)
    assert prefix_trie.prefix_products(turns, place, base).tolist() == want
    assert prefix_trie.raised(base, place).tolist() == [pow(base, int(n), prefix_trie.PRIME) for n in place]


def test_nothing(spark):
    rows = frame_of(spark, [(1, 0, "user", "a")]).limit(0)
    assert prefix_trie.prefix_trie(rows).count() == 0
    assert prefix_trie.prefix_trie(frame_of(spark, [(None, 0, "user", "a")])).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(entry.queries()["op12_prefix_trie"](spark, FOLDER)) == trie(rows)
