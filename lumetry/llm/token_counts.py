"""Token counts by finite-state transducers, without building the tokens.

A byte-level BPE is compiled into two deterministic transducers. The first reads classes of characters and marks where
pieces begin (a word with the space before it, a run of digits, ...). It has eleven states, so every chunk of a text is
run from all of them at once; the chunks' state maps are composed by a parallel prefix scan, which gives each chunk the
state it begins in, and a second run from there writes the marks.

The second reads the bytes of a piece, and each transition is annotated with the number of tokens by which the encoding
of the bytes so far grows (which may be negative, as when `th` and `e` become `the`). Its states hold what later bytes
can depend on: the longest suffix that begins some token, and for every place such a suffix begins at, the last token of
the encoding up to there and the number of tokens since. The encoding of a prefix ends with the one token that may follow
the last token of what is before it; whether two tokens may stand side by side is settled by their merges alone. States
and transitions are compiled when first met and kept by the worker. All pieces are read side by side, a byte of each at a
time; a long piece is cut into segments that start from guessed states, whose maps are composed until every segment starts
where the one before it ended.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, blocks, gathered, spans
from .tokens import public_path

LIMIT = 512
BLOCK = 1 << 18  # characters handled at a time
WINDOW = 1 << 20  # a longer text is read through windows of so many characters
CHUNK = 64  # characters of a chunk of the first transducer
SEGMENT, WARM_UP = 64, 24  # bytes of a segment of a long piece, and those read before it to guess its first state
STATES = 1 << 19  # a worker that has compiled more states starts anew, between two blocks

# States of the first transducer.
FRESH, LETTERS, DIGITS, OTHERS, ONE_SPACE, SPACES, ONE_WHITE, WHITES, QUOTE, QUOTE_RV, QUOTE_L = range(11)
# Classes of characters. The letters of contractions ('s 't 'm 'd 're 've 'll) have classes of their own.
LETTER, STMD, RV, EL, EE, DIGIT, OTHER, APOSTROPHE, SPACE, WHITE, END, UNKNOWN = range(12)
HERE, BEFORE = 1, 2  # a piece begins with this character, or with the one before it


def piece_step(state: int, kind: int) -> tuple[int, int]:
    """The next state and the marks, for one character."""
    if kind == END:
        return FRESH, BEFORE if state in (QUOTE_RV, QUOTE_L) else 0
    if state in (QUOTE_RV, QUOTE_L):
        if (state, kind) in ((QUOTE_RV, EE), (QUOTE_L, EL)):
            return FRESH, 0
        after, marks = piece_step(LETTERS, kind)  # no contraction: the letter has begun a word
        return after, marks | BEFORE
    if state == QUOTE:
        if kind in (STMD, RV, EL):
            return {STMD: FRESH, RV: QUOTE_RV, EL: QUOTE_L}[kind], 0
        state = OTHERS
    if kind in (SPACE, WHITE):
        if state in (ONE_SPACE, SPACES, ONE_WHITE, WHITES):
            return (SPACES if kind == SPACE else WHITES), 0
        return (ONE_SPACE if kind == SPACE else ONE_WHITE), HERE
    run = LETTERS if kind <= EE else DIGITS if kind == DIGIT else OTHERS
    if state in (run, ONE_SPACE):
        return run, 0
    if state == SPACES:
        return run, BEFORE  # the last space belongs to the run
    # The last white space before something else stands apart from the rest of its run.
    marks = HERE | BEFORE if state == WHITES else HERE
    return (QUOTE if kind == APOSTROPHE else run), marks


_STEPS = [[piece_step(state, kind) for kind in range(END + 1)] for state in range(QUOTE_L + 1)]
NEXT = np.array([[after for after, _ in row] for row in _STEPS], np.uint8)
MARKS = np.array([[marks for _, marks in row] for row in _STEPS], np.uint8)


def piece_marks(kinds: np.ndarray) -> np.ndarray:
    """The marks of all characters, from the chunks' state maps."""
    count = -(-len(kinds) // CHUNK)
    padded = np.full(count * CHUNK, END, np.uint8)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(count, CHUNK).T)
    maps, settled = np.tile(np.arange(len(NEXT), dtype=np.uint8), (count, 1)), False
    for column in columns:
        maps = NEXT[maps, column[:, None]]
        if not settled and (maps == maps[:, :1]).all():  # no chunk's state depends on where it began any more
            maps, settled = maps[:, :1], True
    if not settled:
        step = 1
        while step < count:
            maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.int64), 1)
            step *= 2
    state = np.append(np.uint8(FRESH), maps[:-1, FRESH])
    marks = np.empty_like(columns)
    for row, column in zip(marks, columns):
        row[:] = MARKS[state, column]
        state = NEXT[state, column]
    return marks.T.reshape(-1)[: len(kinds)]


def byte_symbols() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merges of a BPE: which tokens come about, and which may stand side by side."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        symbols = byte_symbols()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        spelled = {vocabulary[s]: bytes([b]) for s, b in symbols.items()}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            token, pair = vocabulary[left + right], (vocabulary[left], vocabulary[right])
            self.rank[pair] = rank
            if token not in spelled:
                self.parts[token] = (*pair, rank)
                spelled[token] = spelled[pair[0]] + spelled[pair[1]]
        self._spines: tuple[dict, dict] = ({}, {})
        self._beside: dict[tuple[int, int], bool] = {}
        self.spelled = {t: s for t, s in spelled.items() if t not in self.parts or self._whole(t)}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of a token, from its byte up, each with the rank of the merge that takes it in."""
        known = self._spines[side]
        if token not in known:
            spine, now, until = [], token, float("inf")
            while True:
                spine.append((now, until))
                if now not in self.parts:
                    break
                until, now = self.parts[now][2], self.parts[now][side]
            known[token] = spine[::-1]
        return known[token]

    def _meet(self, a: int, b: int, last: float) -> bool:
        """Whether the edges of a and b, as they grow, are not merged with each other before the merge of rank `last`."""
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = left[i], right[j]
            rank = self.rank.get((x, y), float("inf"))
            if rank < min(until_x, last) and rank <= until_y:  # of equal merges the one further left comes first
                return False
            if until_x == until_y == float("inf"):
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def _whole(self, token: int) -> bool:
        """Whether the encoding of a token's bytes is the token."""
        a, b, rank = self.parts[token]
        return self._meet(a, b, rank)

    def beside(self, a: int, b: int) -> bool:
        pair = (a, b)
        if pair not in self._beside:
            self._beside[pair] = self._meet(a, b, float("inf"))
        return self._beside[pair]


class Counter:
    """Counts the tokens of texts as the tokenizer of a file encodes them, without special tokens at begin and end."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, cut = described["model"], described["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        level = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        added = described.get("added_tokens") or []
        if not plain or not level or described.get("normalizer") or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} is no plain byte-level BPE")
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        for characters, kind in (("stmd", STMD), ("rv", RV), ("l", EL), ("e", EE), ("'", APOSTROPHE), (" ", SPACE)):
            self.kinds[[ord(c) for c in characters]] = kind
        self.merges = Merges(model["vocab"], model["merges"])
        self._trie()
        self._forget()

    def _trie(self) -> None:
        """All beginnings of tokens, each with the longest other one that ends it (as in Aho and Corasick's automaton)."""
        self.child: dict[int, int] = {}
        self.token, self.depth, self.fail = [-1], [0], [0]
        edges: list[list[tuple[int, int, int]]] = []  # by depth
        for token, spelled in self.merges.spelled.items():
            node = 0
            for depth, byte in enumerate(spelled):
                key = node << 8 | byte
                after = self.child.get(key)
                if after is None:
                    after = self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(depth + 1)
                    self.fail.append(0)
                    if depth == len(edges):
                        edges.append([])
                    edges[depth].append((node, byte, after))
                node = after
            self.token[node] = token
        for level in edges[1:]:
            for node, byte, after in level:
                other = self.fail[node]
                while other and (other << 8 | byte) not in self.child:
                    other = self.fail[other]
                self.fail[after] = self.child.get(other << 8 | byte, 0)

    def _forget(self) -> None:
        first = array("i", [0, -1, 0]).tobytes()
        self.states = [first]  # of each: its node, and the last token and the tokens since for each suffix, longest first
        self.known = {first: 0}
        # Transitions, in a table of open addresses: state << 8 | byte, and next state << 8 | growth + 128.
        self.moves = np.full(1 << 16, -1, np.int64)
        self.results = np.zeros(1 << 16, np.int32)
        self.compiled = 0

    def _slots(self, moves: np.ndarray) -> np.ndarray:
        mixed = moves.astype(U64) * U64(0x9E3779B97F4A7C15)
        return (mixed >> U64(65 - len(self.moves).bit_length())).astype(np.int64)

    def _find(self, moves: np.ndarray) -> np.ndarray:
        """The results of transitions, and -1 for those that are not compiled yet."""
        slots = self._slots(moves)
        there = self.moves[slots]
        found = np.where(there == moves, self.results[slots], -1)
        rest = np.flatnonzero((there != moves) & (there >= 0))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & (len(self.moves) - 1)
            there = self.moves[slots[rest]]
            same = there == moves[rest]
            found[rest[same]] = self.results[slots[rest[same]]]
            rest = rest[~same & (there >= 0)]
        return found

    def _keep(self, moves: np.ndarray, results: np.ndarray) -> None:
        """Put new transitions into the table, which stays half empty."""
        self.compiled += len(moves)
        if 2 * self.compiled > len(self.moves):
            old = self.moves >= 0
            moves, results = np.append(self.moves[old], moves), np.append(self.results[old], results)
            size = 1 << (4 * self.compiled).bit_length()
            self.moves, self.results = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        slots = self._slots(moves)
        while len(moves):
            free = np.flatnonzero(self.moves[slots] < 0)
            _, one = np.unique(slots[free], return_index=True)
            won = free[one]
            self.moves[slots[won]], self.results[slots[won]] = moves[won], results[won]
            left = np.ones(len(moves), bool)
            left[won] = False
            moves, results = moves[left], results[left]
            slots = (slots[left] + 1) & (len(self.moves) - 1)

    def _compile(self, state: int, byte: int) -> int:
        """The transition of a state for a byte."""
        entry = array("i")
        entry.frombytes(self.states[state])
        child, depth, fail, beside = self.child, self.depth, self.fail, self.merges.beside
        after, token, growth, at = 0, -1, 0, entry[0]
        for i in range(1, len(entry), 2):
            found = child.get(at << 8 | byte)
            if found is not None:
                after = after or found
                own = self.token[found]
                if own >= 0 and (entry[i] < 0 or beside(entry[i], own)):
                    token, growth = own, 1 - entry[i + 1]
                    break
            at = fail[at]
        if token < 0 or growth < -127:
            raise ValueError("the vocabulary does not encode every text in one way")
        # A suffix of the next state is one of this state's with the byte after it.
        key, i, place, at = array("i", [after]), 1, entry[0], after
        while at:
            while depth[place] >= depth[at]:
                place, i = fail[place], i + 2
            key.extend((entry[i], entry[i + 1] + growth))
            at = fail[at]
        key.extend((token, 0))
        packed = key.tobytes()
        number = self.known.get(packed)
        if number is None:
            number = self.known[packed] = len(self.states)
            self.states.append(packed)
        return number << 8 | growth + 128

    def _read(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read all spans of bytes side by side from these states: their last states and growths."""
        order = np.argsort(starts - ends, kind="stable")
        at, lengths, state = starts[order], (ends - starts)[order], states[order].astype(np.int64)
        growth = np.zeros(len(order), np.int64)
        left = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")  # spans longer than k
        for k, n in enumerate(left.tolist()):
            moves = state[:n] << 8 | data[at[:n] + k]
            found = self._find(moves)
            missing = np.flatnonzero(found < 0)
            if len(missing):
                new, back = np.unique(moves[missing], return_inverse=True)
                results = np.array([self._compile(move >> 8, move & 255) for move in new.tolist()], np.int32)
                self._keep(new, results)
                found[missing] = results[back]
            state[:n] = found >> 8
            growth[:n] += (found & 255) - 128
        last, total = np.empty_like(state), np.empty_like(growth)
        last[order], total[order] = state, growth
        return last, total

    def _piece_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of tokens of each piece."""
        cuts = np.maximum(-(-(ends - starts) // SEGMENT), 1)
        piece = np.repeat(np.arange(len(starts)), cuts)
        number = gathered(np.zeros(len(cuts), np.int64), cuts)
        first = starts[piece] + number * SEGMENT
        last = np.minimum(first + SEGMENT, ends[piece])
        begin = np.zeros(len(piece), np.int64)
        later = np.flatnonzero(number)
        if len(later):
            begin[later], _ = self._read(data, first[later] - WARM_UP, first[later], np.zeros(len(later), np.int64))
        end, growth = self._read(data, first, last, begin)
        while len(later):
            wrong = later[begin[later] != end[later - 1]]
            if not len(wrong):
                break
            begin[wrong] = end[wrong - 1]
            end[wrong], growth[wrong] = self._read(data, first[wrong], last[wrong], begin[wrong])
        return np.bincount(piece, growth, len(starts)).astype(np.int64)

    def _classes(self, symbols: np.ndarray) -> np.ndarray:
        kinds = self.kinds[symbols]
        if (kinds == UNKNOWN).any():  # the library itself says which run a new character joins
            for symbol in np.unique(symbols[kinds == UNKNOWN]).tolist():
                joins = (k for k, probe in ((LETTER, "a"), (DIGIT, "0"), (OTHER, "!")) if len(self.cut(probe + chr(symbol))) == 1)
                self.kinds[symbol] = next(joins, WHITE)
            kinds = self.kinds[symbols]
        return kinds

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts as bytes, the first and last + 1 bytes of all pieces, and the edges of the texts among them."""
        joined = "\n".join(texts) + "\n"
        kinds = self._classes(np.frombuffer(joined.encode("utf-32-le"), "<u4"))
        edges = spans(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        breaks = edges[1:] - 1
        kinds[breaks] = END
        marks = piece_marks(kinds)
        begins = (marks & HERE) > 0
        begins[:-1] |= (marks[1:] & BEFORE) > 0
        begins[breaks] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(kinds))
        inside = kinds[starts] != END
        starts, ends = starts[inside], ends[inside]
        of_text = np.searchsorted(starts, edges)
        data = np.frombuffer(joined.encode(), np.uint8)
        if len(data) != len(kinds):
            places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            starts, ends = places[starts], places[ends]
        return data, starts, ends, of_text

    def _block(self, texts: list[str]) -> np.ndarray:
        if len(self.states) > STATES:
            self._forget()
        data, starts, ends, edges = self._pieces(texts)
        return np.diff(spans(self._piece_counts(data, starts, ends))[edges])

    def _long(self, text: str) -> int:
        """A long text window by window. A window goes on where the last but one piece of the one before begins."""
        total, at, size = 0, 0, WINDOW
        while at + size < len(text):
            data, starts, ends, _ = self._pieces([text[at : at + size]])
            if len(starts) < 3:
                size *= 2  # a piece that is longer than a window
                continue
            total += int(self._piece_counts(data, starts[:-2], ends[:-2]).sum())
            at, size = at + len(bytes(data[: starts[-2]]).decode()), WINDOW
        return total + int(self._block([text[at:]])[0])

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text. A special token's string is one token and parts what stands around it."""
        counts = np.zeros(len(texts), np.int64)
        owners, parts = [], []
        for i, text in enumerate(texts):
            own = self.special.split(text) if self.special else [text]
            counts[i] = len(own) - 1
            for part in own:
                if len(part) > WINDOW:
                    counts[i] += self._long(part)
                elif part:
                    owners.append(i)
                    parts.append(part)
        for part in blocks(parts, BLOCK):
            np.add.at(counts, owners[part], self._block(parts[part]))
        return counts


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker process, which keeps what it has compiled."""
    return Counter(path)


def _counted(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = counter(path or public_path()).count([t or "" for t in batch.column(2).to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts)], names=["doc_id", "n_bytes", "n_tokens"]
        )


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens) of every row.

    Counts are those of the library for the tokenizer's file, a plain byte-level BPE; any other is refused with a
    ValueError. Nothing is truncated or padded. A null text counts as empty: no bytes, no tokens. Rows that repeat a
    doc_id count each; a null doc_id stays null. An empty table gives no rows. Columns but doc_id and text are not read. A
    text of a million characters or more goes through windows; a single piece longer than that (letters without a break)
    is held whole.
    """
    chosen = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(octet_length(coalesce(text, '')) AS LONG) AS n_bytes", "text")
    counted = chosen.mapInArrow(lambda b: _counted(b, tokenizer), "doc_id LONG, n_bytes LONG, n_tokens LONG")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
