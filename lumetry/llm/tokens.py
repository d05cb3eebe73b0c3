"""Token ids of whole texts by the tokenizers library, at a price that falls with repeated words.

A byte-level BPE first cuts a text into pieces (a word with the space before it, a run of digits, ...) and merges inside
a piece only. So the ids of a text are those of its pieces, one after the other: pieces are cut and looked up with
numpy, and the library encodes each piece that a worker has not met lately.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from .common import U64, blocks, gathered, span_hashes, spans

LETTER, DIGIT, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
BLOCK = 1 << 19  # characters handled at a time
LONGEST = 64  # longer pieces are not remembered
SLOTS = 21  # the table of remembered pieces has 2**SLOTS places


class Encoder:
    """For the byte-level BPE whose pieces are contractions, [space] letters, [space] digits, [space] others, space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        size = self.model.get_vocab_size()
        self.opens = np.array([(self.model.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.line_end = self._encoded(["\n"])[0][0]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(1 << SLOTS, U64)
        self.entries = np.zeros(1 << SLOTS, np.int32)
        self.known = self.used = 0
        self.ids = np.zeros(1 << 20, np.uint32)
        self.edges = np.zeros(1 << 18, np.int64)

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(pieces, add_special_tokens=False)]

    def _kinds(self, symbols: np.ndarray) -> np.ndarray:
        kinds = self.kinds[symbols]
        if (kinds == UNKNOWN).any():  # the library itself says to which run a new character joins
            cut = self.model.pre_tokenizer.pre_tokenize_str
            for symbol in np.unique(symbols[kinds == UNKNOWN]).tolist():
                joins = (k for k, probe in ((LETTER, "a"), (DIGIT, "0"), (OTHER, "!")) if len(cut(probe + chr(symbol))) == 1)
                self.kinds[symbol] = next(joins, SPACE)
            kinds = self.kinds[symbols]
        return kinds

    def _starts(self, symbols: np.ndarray, kinds: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Where pieces begin. firsts: the first characters of the texts."""
        n = len(symbols)
        first = np.zeros(n + 1, bool)
        first[firsts] = first[n] = True
        space = kinds == SPACE
        starts = np.ones(n, bool)
        before = kinds[:-1]
        # A run goes on while the kind does. One blank before a run belongs to it.
        starts[1:] = kinds[1:] != before
        starts[1:] &= ~(space[:-1] & (symbols[:-1] == 32))
        # The last white space before something else stands apart from the rest of its run.
        ends_run = np.zeros(n, bool)
        ends_run[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
        inside = np.zeros(n, bool)
        inside[1:] = space[1:] & space[:-1]
        starts = np.where(inside, ends_run, starts | first[:n])
        starts |= first[:n]
        for i in np.flatnonzero(symbols == 39).tolist():  # contractions: 's 't 'm 'd 're 've 'll
            if not first[i] and (kinds[i - 1] == OTHER or symbols[i - 1] == 32):
                continue
            rest = []
            for j in (i + 1, i + 2):
                if j >= n or first[j]:
                    break
                rest.append(int(symbols[j]))
            word = "".join(map(chr, rest))
            length = 1 if word[:1] in ("s", "t", "m", "d") else 2 if word in ("re", "ve", "ll") else 0
            if length:
                starts[i + 1 : i + 1 + length] = False
                if i + 1 + length < n:
                    starts[i + 1 + length] |= kinds[i + 1 + length] == LETTER
        return np.flatnonzero(starts)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes >> U64(64 - SLOTS)).astype(np.int64)
        keys = self.keys[slots]
        found = np.where(keys == hashes, self.entries[slots], -1)
        rest = np.flatnonzero((keys != hashes) & (keys != 0))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & ((1 << SLOTS) - 1)
            keys = self.keys[slots[rest]]
            same = keys == hashes[rest]
            found[rest[same]] = self.entries[slots[rest[same]]]
            rest = rest[~same & (keys != 0)]
        return found

    def _keep(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        slots = (hashes >> U64(64 - SLOTS)).astype(np.int64)
        while len(hashes):
            free = np.flatnonzero(self.keys[slots] == 0)
            _, one = np.unique(slots[free], return_index=True)
            won = free[one]
            self.keys[slots[won]] = hashes[won]
            self.entries[slots[won]] = entries[won]
            left = np.ones(len(hashes), bool)
            left[won] = False
            hashes, entries = hashes[left], entries[left]
            slots = (slots[left] + 1) & ((1 << SLOTS) - 1)

    def _append(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Remember the ids of pieces, one after the other; returns the pieces' entries."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.known + len(counts) + 1 > len(self.edges):
            self.edges = np.concatenate([self.edges, np.zeros_like(self.edges)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.edges[self.known + 1 : self.known + 1 + len(counts)] = self.used + np.cumsum(counts)
        entries = np.arange(self.known, self.known + len(counts))
        self.known, self.used = self.known + len(counts), self.used + len(ids)
        return entries

    def _add(self, pieces: list[str]) -> np.ndarray:
        """Encode pieces and remember them; returns their entries.

        Pieces are encoded hundreds at a time, as a text that is cut into just these pieces: those with a leading space
        as they are, and others on a line each.
        """
        entries = np.full(len(pieces), -1, np.int64)
        kind = [self.kinds[ord(p[0])] for p in pieces]
        spaced = [i for i, p in enumerate(pieces) if len(p) > 1 and p[0] == " " and self.kinds[ord(p[1])] != SPACE]
        plain = [i for i, k in enumerate(kind) if k != SPACE]
        for chosen, glue in ((spaced, ""), (plain, "\n")):
            runs = [chosen[k : k + 256] for k in range(0, len(chosen), 256)]
            for run, ids in zip(runs, self._encoded([glue + glue.join([pieces[i] for i in run]) for run in runs])):
                ids = np.array(ids, np.uint32)
                opens = self.opens[ids] if not glue else ids == self.line_end
                at = np.flatnonzero(opens)
                if len(at) == len(run):
                    counts = np.diff(np.append(at, len(ids))) - len(glue)
                    entries[run] = self._append(ids[~opens] if glue else ids, counts)
        rest = np.flatnonzero(entries < 0)
        for i, ids in zip(rest.tolist(), self._encoded([pieces[i] for i in rest])):
            entries[i] = self._append(np.array(ids, np.uint32), np.array([len(ids)]))[0]
        return entries

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if self.known > 0.6 * (1 << SLOTS):
            self._forget()
        symbols = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        edges = spans(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = self._starts(symbols, self._kinds(symbols), edges[:-1][edges[:-1] < edges[1:]])
        ends = np.append(starts[1:], len(symbols))
        hashes = span_hashes(symbols, starts, ends)
        hashes[hashes == 0] = 1
        found = self._find(hashes)
        long = ends - starts > LONGEST
        found[long] = -1
        missing = np.flatnonzero(found < 0)
        if len(missing):
            words = missing[~long[missing]]
            new, one, back = np.unique(hashes[words], return_index=True, return_inverse=True)
            fresh = np.concatenate([words[one], missing[long[missing]]])
            entries = self._add([joined[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())])
            self._keep(new, entries[: len(new)].astype(np.int32))
            found[words] = entries[: len(new)][back]
            found[fresh[len(new) :]] = entries[len(new) :]
        begin = self.edges[found]
        counts = self.edges[found + 1] - begin
        sums = spans(counts)
        bounds = sums[np.searchsorted(starts, edges)]
        return self.ids[gathered(begin, counts)], np.diff(bounds)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and each text's number of ids."""
        parts = [self._block(texts[part]) for part in blocks(texts, BLOCK)]
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, which keeps what it has met."""
    return Encoder(path)


def public_path(name: str = "byte_bpe_50k.json") -> str:
    """Where this machine has the file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_with_end(texts: list[str], path: str | None = None, end_id: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Like encode, with `end_id` after each text."""
    ids, counts = encoder(path or public_path()).encode(texts)
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1
