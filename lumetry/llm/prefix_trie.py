"""A trie of conversations that share beginnings, by fingerprints that compose.

A turn is an element of a monoid, the map x -> x * BASE + turn modulo the prime 2**61 - 1 (twice, with two bases). The
fingerprint of a sequence is the product of its turns' maps, so that of a conversation that was put together, the head of
one and the rest of another, follows from fingerprints of both: with P(j) for the first j own turns and H for the head,
the head and the own turns after the h-th up to the j-th have P(j) + (H - P(h)) * BASE**(j - h). No rebuilt text is made.

Turns are dealt out by ranges of (conversation, turn), so a conversation of any length is split over tasks. Each task
multiplies its own turns in a segmented prefix scan; the products of the conversations that go on from one task to the
next, one for each task, are then put before them.

Rebuilt conversations with equal fingerprints at a depth are one node. That they are equal is verified: the members of a
node must refer to equal stored turns (by 60 bits of SHA-256) as their last, and so must those of the nodes above it;
should two fingerprints ever coincide by chance, all is done again with other bases.

A node belongs to its smallest member, and the nodes of one member are the lower end of its path, its chain. So what is
summed over a subtree is the rest of the node's own chain, and the whole chains of its other members: no level of the
trie waits for another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, partitions, settled

PRIME = (1 << 61) - 1
FAMILY = 20  # conversations whose number begins alike continue the first of them
HEAD = 3  # turns that a head has at most
BLOCK = 1024  # nodes of a chain that are summed in one window
PIECE = 4096  # neighbouring numbers of conversations that are joined to one text
NO_MEMBER = hashlib.sha256(b"").hexdigest()
WORD = "[^\\x20\\x09-\\x0D]+"


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it."""
    low, mask = U64((1 << 31) - 1), U64((1 << 30) - 1)
    a1, a0, b1, b0 = a >> U64(31), a & low, b >> U64(31), b & low
    middle = a1 * b0 + a0 * b1
    return reduced(U64(2) * a1 * b1 + (middle >> U64(30)) + ((middle & mask) << U64(31)) + a0 * b0)


def reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U64(PRIME)) + (x >> U64(61))
    return np.where(x >= U64(PRIME), x - U64(PRIME), x)


def bases(seed: int) -> tuple[int, int]:
    """Two bases, other ones for each seed."""
    drawn = hashlib.sha256(f"conversation {seed}".encode()).digest()
    return tuple(int.from_bytes(drawn[8 * k : 8 * k + 8], "big") % (PRIME - 1) + 1 for k in (0, 1))  # type: ignore[return-value]


def raised(base: int, exponents: np.ndarray) -> np.ndarray:
    """Powers of a base modulo PRIME."""
    result, square = np.ones(len(exponents), U64), np.array([base], U64)
    rest = exponents.astype(np.int64).copy()
    while rest.any():
        odd = (rest & 1).astype(bool)
        result[odd] = times(result[odd], square)
        square, rest = times(square, square), rest >> 1
    return result


def prefix_products(turns: np.ndarray, place: np.ndarray, base: int) -> np.ndarray:
    """For each row the product of its segment's rows up to it; place: the row's number in its segment, from 1."""
    product, step, power = turns.copy(), 1, np.array([base], U64)
    while (later := np.flatnonzero(place > step)).size:  # so far a product covers `step` rows, or all from the segment's first
        product[later] = reduced(times(product[later - step], power) + product[later])
        step, power = 2 * step, times(power, power)
    return product


TURNS = "part LONG, edge INT, conv_id LONG, place LONG, f1 LONG, f2 LONG, ref LONG, words LONG"


def _scanned(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, ref, other, words) in order, with the products of each conversation's rows in this task.

    edge: 1 for the task's first row, 2 for its last, 3 for one that is both.
    """
    part, before, held = TaskContext.get().partitionId(), None, None

    def marked(rows: list[np.ndarray], edge: int) -> pa.RecordBatch:
        rows[1][-1] |= edge
        return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=[f.split()[0] for f in TURNS.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        conv, ref, other, words = (batch.column(i).to_numpy() for i in range(4))
        n = len(conv)
        opens = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        place = np.arange(n) - np.repeat(opens, np.diff(np.append(opens, n))) + 1
        products = [prefix_products(x.astype(U64), place, base) for x, base in zip((ref, other), bases(seed))]
        if before is not None and before[0] == conv[0]:  # the last batch's last conversation goes on
            mine = slice(0, opens[1] if len(opens) > 1 else n)
            for k, base in enumerate(bases(seed)):
                shifted = times(np.full(place[mine].shape, before[2 + k], U64), raised(base, place[mine]))
                products[k][mine] = reduced(shifted + products[k][mine])
            place[mine] += before[1]
        edge = np.zeros(n, np.int32)
        edge[0] = before is None
        before = (conv[-1], place[-1], products[0][-1], products[1][-1])
        if held is not None:
            yield marked(held, 0)
        held = [np.full(n, part, np.int64), edge, conv, place, *(p.astype(np.int64) for p in products), ref, words]
    if held is not None:
        yield marked(held, 2)


def _carries(edges: list, seed: int) -> dict[int, tuple[int, int, int, int]]:
    """For each task whose first conversation began in an earlier one: its number, and the place and products before it.

    edges: the first and the last row of each task.
    """
    of_part: dict[int, dict[int, tuple]] = {}
    for row in edges:
        for bit in (1, 2):
            if row["edge"] & bit:
                of_part.setdefault(row["part"], {})[bit] = tuple(row[c] for c in ("conv_id", "place", "f1", "f2"))
    carries: dict[int, tuple[int, int, int, int]] = {}
    state = None
    for part in sorted(of_part):
        first, last = of_part[part][1], of_part[part][2]
        if state is not None and state[0] == first[0]:
            carries[part] = state
        if state is not None and state[0] == last[0]:
            n = last[1]
            state = (last[0], state[1] + n, *((g * pow(b, n, PRIME) + f) % PRIME for g, b, f in zip(state[2:], bases(seed), last[2:])))
        else:
            state = last
    return carries


def _carried(batches: Iterator[pa.RecordBatch], carries: dict[int, tuple[int, int, int, int]], seed: int) -> Iterator[pa.RecordBatch]:
    """The rows of _scanned, with what came before in earlier tasks."""
    for batch in batches:
        part, _, conv, place, f1, f2, ref, words = (batch.column(i).to_numpy().copy() for i in range(8))
        for number in np.unique(part).tolist():
            if number in carries:
                known, n, *given = carries[number]
                mine = np.flatnonzero((part == number) & (conv == known))
                for product, base, g in zip((f1, f2), bases(seed), given):
                    shifted = times(np.full(len(mine), g, U64), raised(base, place[mine]))
                    product[mine] = reduced(shifted + product[mine].astype(U64)).astype(np.int64)
                place[mine] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (conv, place, f1, f2, ref, words)], names=["conv_id", "place", "f1", "f2", "ref", "words"]
        )


def _rebuilt(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Own turns (conv_id, depth, size, after, f1, f2, d1, d2, ref, words) with the fingerprints of rebuilt conversations.

    after: turns since the head; d1 and d2: the head's fingerprint less that of the turns that it stands for.
    """
    for batch in batches:
        columns = [batch.column(i) for i in range(10)]
        after = columns[3].to_numpy()
        for k, base in enumerate(bases(seed)):
            own, less = (columns[i + k].to_numpy().astype(U64) for i in (4, 6))
            columns[4 + k] = pa.array(reduced(times(less, raised(base, after)) + own).astype(np.int64))
        kept = [0, 1, 2, 4, 5, 8, 9]
        yield pa.RecordBatch.from_arrays([columns[i] for i in kept], names=["conv_id", "depth", "size", "f1", "f2", "ref", "words"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts (third column on) of equal keys, which come one after the other, joined by commas."""
    key, running = None, None

    def result(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(x, kind) for x, kind in zip(zip(*found) if found else ([],) * 4, kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["depth", "f1", "f2", "ends_sha256"])

    for batch in batches:
        found = []
        for *now, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if now != key:
                if running is not None:
                    found.append((*key, running.hexdigest()))
                key, running = now, hashlib.sha256(text.encode())
            else:
                running.update(b"," + text.encode())
        yield result(found)
    if running is not None:
        yield result([(*key, running.hexdigest())])


def _stored(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, 120 bits of a hash of role and text (ref and other), and the number of words of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role comes first, so that no two pairs of texts are joined alike.
    hashed = F.sha2(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text), "utf-8"), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        hashed.alias("hashed"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    ref, other = (F.conv(F.substring("hashed", k, 15), 16, 10).cast("long") for k in (1, 16))
    return rows.select("conv_id", "turn", ref.alias("ref"), other.alias("other"), "words")


def _minus(a: str, b: str) -> Column:
    return F.pmod(F.expr(a) - F.expr(b), F.lit(PRIME))


def _heads(turns: DataFrame) -> DataFrame:
    """Of each conversation: size, and its first turns' fingerprints, references and words (f1_1, ..., words_3)."""
    first = [
        F.max(F.when(F.col("place") == k, F.col(c))).alias(f"{c}_{k}") for k in range(1, HEAD + 1) for c in ("f1", "f2", "ref", "words")
    ]
    return turns.groupBy("conv_id").agg(F.max("place").alias("size"), *first)


def family() -> Column:
    """The conversation whose head a conversation gets."""
    return F.col("conv_id") - F.col("conv_id") % FAMILY


def _plans(heads: DataFrame) -> DataFrame:
    """How each conversation is put together: h, own turns that the head stands for; k, turns of the head; size; d1 and d2,
    the head's fingerprints less those of the first h own turns; head, its turns."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).alias("h")
    base = heads.where(F.col("conv_id") % FAMILY == 0)
    base = base.select(*(F.col(c).alias(f"base_{c}") for c in base.columns))
    both = heads.select("*", h, family().alias("family")).join(base, F.col("family") == F.col("base_conv_id"), "left")
    both = both.withColumn("k", F.least("h", F.coalesce("base_size", F.lit(0).cast("long"))))

    def product(lane: str, prefix: str, at: str) -> str:
        return f"CASE {at} {' '.join(f'WHEN {k} THEN coalesce({prefix}{lane}_{k}, 0)' for k in range(1, HEAD + 1))} ELSE 0 END"

    lanes = [_minus(product(f"f{i}", "base_", "k"), product(f"f{i}", "", "h")).alias(f"d{i}") for i in (1, 2)]
    turn = [F.struct(*(F.col(f"base_{c}_{k}").alias(c) for c in ("f1", "f2", "ref", "words"))) for k in range(1, HEAD + 1)]
    size = (F.col("k") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("size")
    return both.select("conv_id", "h", "k", size, *lanes, F.slice(F.array(*turn), 1, F.col("k").cast("int")).alias("head"))


def _members(conversations: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """A row for each rebuilt conversation and depth: conv_id, depth, size, f1, f2, ref and words of the last turn; and how
    each conversation is put together, see _plans."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "ref", "other"]
    rows = _stored(conversations).repartitionByRange(partitions(conversations), *order).sortWithinPartitions(*order)
    rows = rows.select("conv_id", "ref", "other", "words")
    scanned = settled(rows.mapInArrow(lambda b: _scanned(b, seed), TURNS), "turns")
    # Two rows for each task that read turns.
    edges = scanned.where("edge > 0").select("part", "edge", "conv_id", "place", "f1", "f2").collect()
    carries = _carries(edges, seed)
    schema = "conv_id LONG, place LONG, f1 LONG, f2 LONG, ref LONG, words LONG"
    turns = scanned.mapInArrow(lambda b: _carried(b, carries, seed), schema)
    plans = settled(_plans(_heads(turns)), "plans")
    after = F.col("place") - F.col("h")
    own = turns.join(plans.drop("head"), "conv_id").where("place > h").select(
        "conv_id", (F.col("k") + after).alias("depth"), "size", after.alias("after"), "f1", "f2", "d1", "d2", "ref", "words"
    )
    members = "conv_id LONG, depth LONG, size LONG, f1 LONG, f2 LONG, ref LONG, words LONG"
    own = own.mapInArrow(lambda b: _rebuilt(b, seed), members)
    head = plans.select("conv_id", F.posexplode("head").alias("at", "turn"), "size")
    head = head.select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), "size", "turn.f1", "turn.f2", "turn.ref", "turn.words")
    zero = F.lit(0).cast("long")
    top = plans.select("conv_id", zero.alias("depth"), "size", *(zero.alias(c) for c in ("f1", "f2", "ref", "words")))
    return settled(own.unionByName(head).unionByName(top), "members"), plans


KEY = ["depth", "f1", "f2"]


def _ends(members: DataFrame) -> DataFrame:
    """KEY and ends_sha256 of the nodes at which some member ends.

    Numbers are joined to texts of at most PIECE numbers each, whatever their node; the texts of a node are hashed in turn.
    """
    ends = members.where("depth = size").select(*KEY, "conv_id", F.expr(f"conv_id DIV {PIECE}").alias("piece"))
    texts = ends.groupBy(*KEY, "piece").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    texts = texts.select(*KEY, "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("text"))
    dealt = texts.repartition(partitions(members), *KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "text")
    return dealt.mapInArrow(_digests, "depth LONG, f1 LONG, f2 LONG, ends_sha256 STRING")


def _saved_below(nodes: DataFrame) -> DataFrame:
    """KEY and, summed over the node and those below it in its chain, the words that sharing saves.

    A chain is summed in blocks of BLOCK nodes, and then over its blocks: no window holds more than that of one chain.
    """
    saved = "(n_convs - 1) * words"
    rows = nodes.selectExpr(*KEY, "conv_id", f"{saved} AS saved", f"depth DIV {BLOCK} AS block")
    sums = rows.groupBy("conv_id", "block").agg(F.sum("saved").alias("of_block"))
    later = "sum(of_block) OVER (PARTITION BY conv_id ORDER BY block DESC) - of_block AS later"
    own = "sum(saved) OVER (PARTITION BY conv_id, block ORDER BY depth DESC) AS own"
    both = rows.selectExpr(*KEY, "conv_id", "block", own).join(sums.selectExpr("conv_id", "block", later), ["conv_id", "block"])
    return both.selectExpr(*KEY, "own + later AS below")


def prefix_trie(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, from the textless root down: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and text_conv_id and text_turn, the stored turn (by its number from 1
    in the order of a conversation's turns) that is the node's last.

    A conversation's turns are those of its conv_id, by turn; a null turn comes first, and equal ones in the order of a
    hash of their content. A null role or text counts as empty. Rebuilt, conversation c has the first h turns of
    conversation c - c % 20 (all if it has fewer, none if there is none; the sign of % is that of c), and then its own
    after the first h; h is crc32(c) % 4. Rows without a conv_id are left out. An empty table gives no rows. Other columns
    are not read.
    """
    members, plans = _members(conversations, seed)
    nodes = members.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("ref").alias("ref"),
        F.max("ref").alias("other_ref"),
        F.min("words").alias("words"),
        F.max("size").alias("longest"),
    )
    nodes = settled(nodes, "nodes")
    if nodes.where("ref <> other_ref").take(1):
        return prefix_trie(conversations, seed + 1)
    leaf = F.max((F.col("longest") == F.col("depth")).cast("long"))
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("first"),
        F.max("depth").alias("last"),
        F.sum(F.expr("(n_convs - 1) * words")).alias("saved"),
        leaf.alias("leaf"),
    )
    chains = settled(chains, "chains")
    # Members in nodes that are not their own: what lies below those nodes in the members' chains.
    others = members.select(*KEY, "conv_id").join(chains, "conv_id").where("depth < first")
    others = settled(others.select(*KEY, "conv_id", "first", "saved", "leaf"), "others")
    branches = F.col("first") == F.col("depth") + 1
    sums = others.groupBy(*KEY).agg(
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"), F.sum(branches.cast("long")).alias("children")
    )
    parents = others.where(branches).join(nodes.select(*KEY, F.col("conv_id").alias("parent")), KEY)
    chains = chains.join(parents.select("conv_id", "parent"), "conv_id", "left")
    of_chain = chains.drop("saved").join(plans.select("conv_id", "h", "k"), "conv_id")
    found = nodes.select(*KEY, "conv_id", "n_convs").join(sums, KEY, "left").join(_ends(members), KEY, "left")
    found = found.join(_saved_below(nodes), KEY).join(of_chain, "conv_id")
    none = F.lit(0).cast("long")
    return found.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("children", none) + (F.col("depth") < F.col("last")).cast("long")).alias("n_children"),
        (F.coalesce("leaves", none) + F.col("leaf")).alias("n_leaves"),
        (F.coalesce("saved", none) + F.col("below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_MEMBER)).alias("ends_sha256"),
        F.when(F.col("depth") > F.col("k"), F.col("conv_id")).when(F.col("depth") > 0, family()).alias("text_conv_id"),
        F.when(F.col("depth") > F.col("k"), F.col("depth") - F.col("k") + F.col("h"))
        .when(F.col("depth") > 0, F.col("depth"))
        .alias("text_turn"),
    )
