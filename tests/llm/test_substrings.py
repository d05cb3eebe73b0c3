"""Repeated passages: what is removed stands earlier as one passage, and every passage of sixty words that does is removed."""

import os
import random

import numpy as np
import pytest

from lumetry.llm import substrings
from lumetry.llm.common import importable, settled, working_tables

from .conftest import CLASHING, WORDS, prose

LINES = [f"{a} and {b} say {c} once more.\n" for a, b, c in zip(WORDS, WORDS[3:] + WORDS[:3], WORDS[5:] + WORDS[:5])]


def sentence(chance, n):
    """n words that hardly stand anywhere else, some of them short."""
    return " ".join(chance.choice(["a", "of", "to", f"{chance.choice(WORDS)}{chance.randrange(10**6)}"]) for _ in range(n))


def documents(seed):
    """Texts that share short lines everywhere, and some of them passages of 55 to 200 words."""
    chance = random.Random(seed)
    passages = [sentence(chance, n) for n in (55, 60, 70, 80, 120, 200)]
    passages.append("".join(LINES[k % 16] for k in range(0, 40, 3)))  # of common lines only, in an order of its own
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(chance.randint(1, 5)):
            parts.append(chance.choice([sentence(chance, chance.randint(5, 60)), chance.choice(LINES), chance.choice(LINES)]))
            if chance.random() < 0.25:
                parts.append(chance.choice(passages))
        texts.append(chance.choice([" ", "\n"]).join(parts))
    return texts


def words_with_places(text):
    data, found, at = text.encode(), [], 0
    while at < len(data):
        if substrings.WORD_BYTE[data[at]]:
            end = at
            while end < len(data) and substrings.WORD_BYTE[data[end]]:
                end += 1
            found.append((at, end))
            at = end
        else:
            at += 1
    return data, found


def windows(text, n):
    """The bytes of n consecutive words, and of how they are parted, by the number of the first."""
    data, places = words_with_places(text)
    return {k: data[places[k][0] : places[k + n - 1][1]] for k in range(len(places) - n + 1)}


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_and_nothing_else_go(spark, seed):
    texts = documents(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(5)
    rows = {r["doc_id"]: r for r in substrings.deduplicated(docs).collect()}
    removed, missed, seen_50, seen_60 = 0, 0, set(), set()
    for i, text in enumerate(texts):
        data, places = words_with_places(text)
        gone = set()
        for span in rows[i]["removed_spans"]:
            gone |= {k for k, (a, b) in enumerate(places) if span["first"] <= a and b <= span["last"]}
        earlier = set()
        own_50, own_60 = windows(text, 50), windows(text, 60)
        for k, window in own_50.items():
            if window in seen_50 or any(own_50[j] == window for j in range(max(0, k))):
                earlier |= set(range(k, k + 50))
        assert gone <= earlier and rows[i]["removed_words"] == len(gone)
        kept = [data[a:b].decode() for k, (a, b) in enumerate(places) if k not in gone]
        assert [t for t in words_of(rows[i]["text"])] == kept
        for k, window in own_60.items():
            if window in seen_60 and not gone & set(range(k, k + 60)):
                missed += 1
        seen_50 |= set(own_50.values())
        seen_60 |= set(own_60.values())
        removed += len(gone)
    assert removed > 500 and missed == 0


def words_of(text):
    data, places = words_with_places(text)
    return [data[a:b].decode() for a, b in places]


def test_lines_of_many_texts_are_no_passage(spark):
    """Five lines of twenty words, each from another text, never stood together."""
    chance = random.Random(7)
    lines = [sentence(chance, 20) + "\n" for _ in range(5)]
    texts = [sentence(chance, 30) + "\n" + line + sentence(chance, 30) for line in lines] + ["".join(lines)]
    rows = substrings.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate(texts))


def test_repeated_and_missing_ids(spark):
    passage = prose(3, 90)
    texts = [(7, "one " + passage), (7, "two. " + passage), (8, "three. " + passage), (None, "four. " + passage), (8, passage), (8, passage)]
    docs = spark.createDataFrame(texts, "doc_id LONG, text STRING").repartition(4)
    rows = substrings.deduplicated(docs).collect()
    whole = [r for r in rows if r["text"].endswith(passage)]
    assert len(rows) == 6 and len(whole) == 1 and whole[0]["doc_id"] == 7
    assert sorted(r["text"].strip() for r in rows if r is not whole[0] and r["text"].strip()) in (
        ["four.", "three.", "two."], ["four.", "one", "three."],
    )
    assert [r["text"] for r in rows if r["doc_id"] == 8].count("") == 2


def test_clashing_columns(spark):
    names = ["removed_words", "removed_spans", "id", "tie", "ends", "of", "place", "share", "digest", "__ends", "wanted", "_removed_words"]
    rows = [(1, prose(1, 80), *("x",) * len(names)), (2, prose(1, 80), *("x",) * len(names))]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id LONG, text STRING", *(f"`{n}` STRING" for n in names)]))
    done = substrings.deduplicated(docs)
    assert done.columns == [*docs.columns, "__removed_words", "_removed_spans"]
    found = {r["doc_id"]: r for r in done.collect()}
    assert (found[1]["__removed_words"], found[2]["__removed_words"], found[2]["text"]) == (0, 80, "")
    assert {found[2][n] for n in names} == {"x"}
    assert "digest" in CLASHING


def test_places_of_chunks():
    data = b"one two three\nfour\nfive six seven eight nine ten eleven twelve\n"
    array = np.frombuffer(data, np.uint8)
    edges = np.array([0, 19, len(data)])
    starts = substrings.gear_cuts(array, edges)
    owner = np.searchsorted(edges, starts, "right") - 1
    places = substrings.chunk_places(array, edges, starts, owner)
    for i, place in enumerate(places.tolist()):
        begin = int(starts[i])
        end = int(starts[i + 1]) if i + 1 < len(starts) else len(data)
        first, length, words, before, after = place >> 33, place >> 24 & 511, place >> 16 & 255, place >> 8 & 255, place & 255
        assert first + edges[owner[i]] == begin and length == end - begin
        assert words == sum(begin <= k < end and substrings.WORD_BYTE[data[k]] and not (k and substrings.WORD_BYTE[data[k - 1]]) for k in range(len(data)))
        assert (before == substrings.NO_CHUNK) == (begin in edges) and (after == substrings.NO_CHUNK) == (end in edges)


@pytest.mark.parametrize("times", [150, 300])
def test_words_said_over_and_over_make_few_ends(spark, times):
    """Each period of this pair is a chunk and a piece of its own; those of one text that repeat one original share its ends,
    so there are as many ends however often the pair is said, and no piece is lost."""
    importable(spark)
    pair = "lamp letter. "
    texts = [prose(i, 40) + "\n" + pair * times + "\n" + prose(50 + i, 40) for i in range(6)]
    rows = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "id LONG, tie LONG, text STRING").repartition(3)
    found = substrings.repeated_pieces(rows, 50).collect()
    assert len(found) <= 10 * len(texts)
    for i, text in enumerate(texts):
        firsts = [f for r in found if r["id"] == i and r["before"] for f in r["firsts"]]
        assert len(firsts) == len(set(firsts)) >= times - 30
        data = text.encode()
        for r in found:
            if r["id"] == i:
                original = texts[r["of"]].encode()[r["origin"] : r["origin"] + r["length"]]
                assert {data[f : f + r["length"]] for f in r["firsts"]} == {original}


def test_each_end_meets_its_original_once(spark):
    """Rows that repeat an original in several partitions give its context once."""
    importable(spark)
    passage = prose(3, 90)
    texts = [(1, 5, "one. " + passage + " one")] * 12 + [(i, 0, f"{i}. " + passage + f" {i}") for i in range(2, 8)]
    rows = spark.createDataFrame(texts, "id LONG, tie LONG, text STRING").repartition(6)
    pieces = substrings.repeated_pieces(rows, 50)
    ends = pieces.count()
    completed = substrings._completed(rows, pieces, True).collect()
    assert ends > 0 and len(completed) == ends
    assert all((r["context"] is None) == (r["at"] is None) for r in completed)


def test_tables_of_chunks_go_before_the_texts_are_rewritten(spark, monkeypatch):
    """Only the pieces are read then; with `working_tables` around, they go as well."""
    made = []

    def noted(df, name="rows", keep=False):
        table = settled(df, name, keep)
        made.append((name, table.inputFiles()))
        return table

    monkeypatch.setattr(substrings, "settled", noted)
    docs = spark.createDataFrame([(i, prose(i % 3, 90)) for i in range(9)], "doc_id LONG, text STRING")

    def left():
        return {name for name, files in made if any(os.path.exists(file.removeprefix("file://")) for file in files)}

    assert substrings.deduplicated(docs).where("removed_words > 0").count() == 6
    assert {name for name, _ in made} == {"shared", "copies", "originals", "pieces"} and left() == {"pieces"}
    made.clear()
    with working_tables(spark):
        assert substrings.deduplicated(docs).where("removed_words > 0").count() == 6
        assert left() == {"pieces"}
    assert left() == set()
