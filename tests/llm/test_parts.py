"""The parts that run inside tasks, against brute force."""

import random

import numpy as np
import pytest

from lumetry.llm import near_duplicates, quality, substrings, token_files
from lumetry.llm.common import mix
from lumetry.llm.cover_tree import CoverTree, dual_links, unit
from lumetry.llm.decontamination import Phrases
from lumetry.llm.fm_index import FMIndex
from lumetry.llm.tokens import encoder, public_path

from .conftest import prose


def test_tokens_are_those_of_the_library():
    own = encoder(public_path())
    random_ = random.Random(1)
    parts = ["a", "s", "re", "'", "'s", "'ll", " ", "  ", "\n", "\t", "é", "１", "12", "!", "...", "中", "ß", "́", "😀", "İ", " "]
    parts += ["\x00", "<|endoftext|>", "'ve", "'d x", "\r\n", "​", "²", " '", "stone", " river"]
    for _ in range(1500):
        texts = ["".join(random_.choice(parts) for _ in range(random_.randint(0, 14))) for _ in range(random_.randint(1, 6))]
        want = [e.ids for e in own.model.encode_batch(texts, add_special_tokens=False)]
        ids, counts = own.encode(texts)
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    long = ["x" * 500, prose(1, 3000), "ab " * 4000]
    ids, counts = own.encode(long * 2)
    assert ids.tolist() == sum((e.ids for e in own.model.encode_batch(long * 2, add_special_tokens=False)), [])


@pytest.mark.parametrize("top", [0, 255, 256, 60_000, 2**32 - 1])
def test_codes_give_every_token_back(top):
    random_ = np.random.default_rng(3)
    ids = random_.integers(0, top + 1, 3000).astype(np.uint32)
    codes = token_files.Codes(token_files.encode_codes(ids))
    assert len(codes) == 3000 and (codes.all() == ids).all()
    places = random_.integers(0, 3000, 500)
    assert (codes[places] == ids[places]).all() and codes[2999][0] == ids[2999]
    with pytest.raises(IndexError):
        codes[3000]
    assert len(token_files.Codes(token_files.encode_codes(ids[:0])).all()) == 0


def test_fm_index_finds_every_occurrence():
    random_ = np.random.default_rng(0)
    for round_ in range(150):
        symbols, n = int(random_.integers(1, 6)), int(random_.integers(1, 60))
        text = random_.integers(0, symbols + 1, n) * (random_.random(n) > 0.2)
        if round_ % 7 == 0:
            text = np.ones(n, int)
        text = np.concatenate([[0], text, [0]]).astype(int)
        index, length = FMIndex(text, symbols), int(random_.integers(1, 7))
        patterns = random_.integers(1, symbols + 1, (8, length))
        for pattern, low, high in zip(patterns, *index.search(patterns)):
            want = [i for i in range(len(text) - length + 1) if (text[i : i + length] == pattern).all()]
            assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def test_phrases_mark_words_as_a_plain_search_does():
    texts = [prose(i % 5, 60) + " " + prose(i, 30) for i in range(40)]
    items = [(str(i), " ".join(prose(i, 40).split()[5:25])) for i in range(6)] + [("short", "stone0 lamp17 x")]
    hit, edges, pairs, _ = Phrases(items).find(texts)
    names = Phrases(items).names
    for t, text in enumerate(texts):
        words, want, found = text.split(), set(), set()
        for name, item in items:
            phrase = item.split()
            n = min(10, len(phrase))
            for k in range(len(phrase) - n + 1):
                for j in range(len(words) - n + 1):
                    if words[j : j + n] == phrase[k : k + n]:
                        want |= set(range(j, j + n))
                        found.add(name)
        assert set(np.flatnonzero(hit[edges[t] : edges[t + 1]]).tolist()) == want
        assert {names[i] for text_, i in pairs.tolist() if text_ == t} == found


@pytest.mark.parametrize("spread", [0.0, 0.01, 0.1, 0.3, 1.0])
def test_dual_traversal_counts_every_link(spread):
    random_ = np.random.default_rng(int(spread * 100))
    base = random_.normal(size=(5, 6))

    def some(n):
        return unit((base[random_.integers(0, 5, n)] + spread * random_.normal(size=(n, 6))).tolist())

    for n, m in ((1, 1), (90, 140), (7, 200)):
        x, y = some(n), some(m)
        many_x, many_y = random_.integers(1, 4, n), random_.integers(1, 4, m)
        near = np.einsum("id,jd->ij", x, y) >= 0.95
        count_x, count_y, _ = dual_links(x, CoverTree(x), many_x, y, CoverTree(y), many_y, False, 0.95)
        assert (count_x == near @ many_y).all() and (count_y == many_x @ near).all()
        inner = np.einsum("id,jd->ij", x, x) >= 0.95
        np.fill_diagonal(inner, False)
        count, _, roots = dual_links(x, CoverTree(x), many_x, x, CoverTree(x), many_x, True, 0.95)
        assert (count == inner @ many_x).all()
        assert (roots[np.nonzero(inner)[0]] == roots[np.nonzero(inner)[1]]).all()


@pytest.mark.parametrize(("share", "n"), [(0.8, 700), (0.5, 700), (0.8, 10), (0.3, 20), (0.8, 20_000)])
def test_signatures_estimate_similarity(share, n):
    random_ = np.random.default_rng(n)
    estimates = []
    for _ in range(12):
        pool = mix(random_.integers(0, 2**60, n).astype(np.uint64))
        same, apart = int(round(n * share)), n - int(round(n * share))
        x = np.sort(pool[: same + apart // 2])
        y = np.sort(np.concatenate([pool[:same], pool[same + apart // 2 :]]))
        prints = near_duplicates.signatures(np.concatenate([x, y]), np.ones(n + same), np.array([0, len(x), n + same]))
        estimates.append((prints[0] == prints[1]).mean())
    assert abs(np.mean(estimates) - len(np.intersect1d(x, y)) / n) < 0.025


def test_signatures_weigh_elements():
    random_ = np.random.default_rng(5)
    elements = np.sort(mix(np.arange(300).astype(np.uint64)))
    x = random_.uniform(0.1, 5, 300)
    y = x * random_.uniform(0.5, 1.5, 300)
    prints = near_duplicates.signatures(np.concatenate([elements] * 2), np.concatenate([x, y]), np.array([0, 300, 600]), 2048)
    assert abs((prints[0] == prints[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum()) < 0.03


def test_cuts_do_not_depend_on_what_stands_before():
    passage = prose(3, 200)

    def cuts(before, after):
        data = np.frombuffer((before + passage + after).encode(), np.uint8)
        starts = substrings.gear_cuts(data, np.array([0, len(data)])) - len(before)
        return {int(s) for s in starts if 2 * substrings.ROLL < s <= len(passage)}

    alone = cuts("", "")
    assert len(alone) > 20 and cuts("xyz abc " * 7, " tail") == alone


def test_classifier_tells_held_out_texts_apart():
    good = [prose(i, 60) for i in range(80)]
    bad = [" ".join(w + "!!" for w in prose(i, 60).upper().split()) if i % 2 else f"word{i} " * 60 for i in range(80)]
    rows = []
    for label, texts in ((1, good[:60]), (0, bad[:60])):
        for text in texts:
            keys, counts = np.unique(quality.features([text])[0], return_counts=True)
            rows.append((label, keys, counts.astype("f4")))
    table, bias = quality.train(rows)
    sums, counts = quality.text_sums(good[60:] + bad[60:] + [""], table)
    positive = bias + sums / np.maximum(counts, 1) > 0
    assert positive[:20].all() and not positive[20:40].any()
