"""Token counts against the library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from lumetry.llm import token_counts
from lumetry.llm.common import table
from lumetry.llm.tokens import public_path

FOLDER = "/root/testdata/sf0.001"
CHARACTERS = "ab cde's'tll're  \n\t'\"=-0123456789éü中文×   ALSDVstmdrvle"


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(public_path())
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


def awkward_texts():
    chance = random.Random(6)
    texts = ["".join(chance.choice(CHARACTERS) for _ in range(chance.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(chance.choice("etaoinshr") for _ in range(400)) for _ in range(30)]
    texts += ["".join(chance.choice("=- _*\n") for _ in range(400)) for _ in range(30)]
    texts += ["", "'re", "'r", "'l", "a'", "''s", "x 's", "'s's", "  \n", "a  ", "a \n b", " " * 500 + "x", "=" * 3000, "ab" * 700, "aaaa" * 900]
    return texts + ["<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>\n\n c", "<|endoftext", "hello" * 900]


def test_counts_are_the_librarys(library):
    texts = awkward_texts()
    assert token_counts.Counter(public_path()).count(texts).tolist() == library(texts)


def test_windows_and_new_starts_change_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "WINDOW", 37)
    monkeypatch.setattr(token_counts, "STATES", 200)
    monkeypatch.setattr(token_counts, "CHUNK", 3)
    counter, texts = token_counts.Counter(public_path()), awkward_texts()[::9]
    assert [int(counter.count([t])[0]) for t in texts] == library(texts)


def test_chunk_maps(monkeypatch):
    """Marks from composed maps are those of one run over all characters."""
    kinds = np.random.default_rng(1).integers(0, token_counts.END + 1, 5000).astype(np.uint8)
    state, want = token_counts.FRESH, []
    for kind in kinds.tolist():
        state, marks = token_counts.piece_step(state, kind)
        want.append(marks)
    for chunk in (1, 2, 64, 6000):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        assert token_counts.piece_marks(kinds).tolist() == want


def test_tokens_side_by_side(library):
    """Two tokens may stand side by side if the library encodes their bytes as these two."""
    counter = token_counts.Counter(public_path())
    model, chance = Tokenizer.from_file(public_path()), random.Random(8)
    words = [t for t, s in counter.merges.spelled.items() if s.isalpha() and s.islower()]
    for _ in range(3000):
        a, b = chance.choice(words), chance.choice(words)
        text = (counter.merges.spelled[a] + counter.merges.spelled[b]).decode()
        assert counter.merges.beside(a, b) == (model.encode(text, add_special_tokens=False).ids == [a, b])


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="no plain byte-level BPE"):
        token_counts.Counter(public_path("word_bpe_49k.json"))


def test_awkward(awkward, nothing, library):
    rows = token_counts.token_counts(awkward, limit=100).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.where("doc_id IS NOT NULL").collect()}
    assert len(rows) == 13 and sum(r["doc_id"] is None for r in rows) == 2
    for r in rows:
        if r["doc_id"] is not None:
            (n,) = library([texts[r["doc_id"]]])
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 100)
    assert token_counts.token_counts(nothing).count() == 0


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, FOLDER, "documents").collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    rows = entry.queries()["op13_token_counts"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == {
        i: (len(texts[i].encode()), n, n > 512) for i, n in want.items()
    }
