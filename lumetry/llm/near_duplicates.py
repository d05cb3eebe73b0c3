"""Near-duplicate texts by DartMinHash signatures and banded joining.

A text is a set of weighted elements, its shingles of five words. Hashed darts are thrown at the plane of weight and
time over every element: a dart of coordinate j lies in a text's region if its weight is at most the element's. The
earliest dart of each coordinate is the signature there, and two texts agree on a coordinate with the probability of
their (weighted) Jaccard similarity. Only about t ln t + 2t darts are looked at for t coordinates, whatever the length
of the text, since the time up to which darts are thrown shrinks with the text's total weight (Christiani, 2020).

Equal texts are one class, compared once. Classes that agree on a band of coordinates share a bucket. Its members are
compared with one leader, and only members of one bucket that are still in different components after that with each
other, inside the bucket: their signatures first, and then exactly, with the texts of those alone whose signature is like
another's. A bucket gives no more links than tie its members together, so what is moved grows with the members and not with
their pairs. A bucket of more than some thousand such members is cut into blocks, and each pair of blocks is compared in a
task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, blocks, digest, gathered, mix, partitions, settled, spans, words_of
from .graph import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4  # two texts of similarity 0.8 share no band with a probability of (1 - 0.8**4)**32 = 5e-8
COORDINATES = 3 * BANDS * ROWS  # the bands take the first third; all are used to estimate similarities
DEVIATIONS = 6  # pairs whose estimate is so many standard deviations below the similarity are not compared: one in 10**9
BUCKET = 4096  # members of a bucket, or of a block of a larger one, that are compared with each other in one task;
SHINGLES = 512  # a text of more shingles counts for as many members as it has times so many
BLOCK = 1 << 18  # characters handled at a time

# Time is cut into cells: at first ever longer ones, up to half a dart for each unit of weight, then cells of one dart.
HEADS = np.array([0.0] + [2.0**-k for k in range(9, -1, -1)])


def _darts_in_cell(mean: float) -> np.ndarray:
    """The distribution function of the number of darts in a cell."""
    terms = [np.exp(-mean)]
    while terms[-1] > 1e-18 or len(terms) < 4:
        terms.append(terms[-1] * mean / len(terms))
    return np.cumsum(terms)


CELLS = {mean: _darts_in_cell(mean) for mean in {float(b - a) for a, b in pairwise(HEADS)} | {1.0}}


def shingles(texts: list[str], words: int = WORDS, counted: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every text: its different shingles (hashes, ascending), their weights, and the edges of the texts.

    Weights are 1, or numbers of occurrences if `counted`. A text of fewer words, but not none, is one shingle.
    """
    hashes, _, _, edges = words_of(texts)
    lengths = np.diff(edges)
    sizes = np.where(lengths >= words, lengths - words + 1, np.minimum(lengths, 1))
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.arange(len(owner)) - np.repeat(spans(sizes)[:-1], sizes) + np.repeat(edges[:-1], sizes)
    long = lengths[owner] >= words
    value = np.zeros(len(owner), U64)
    for k in range(words):
        inside = long | (k < lengths[owner])
        at = np.where(inside, first + k, 0)
        value = np.where(inside, mix(value ^ hashes[at]) if len(hashes) else value, value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    weights = np.diff(np.append(at, len(value))).astype(float) if counted else np.ones(len(at))
    return value[at], weights, spans(np.bincount(owner[at], minlength=len(texts)))


def _darts(
    seeds: np.ndarray, cells: np.ndarray, low: float | np.ndarray, length: float, lines: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The darts in one cell for each seed: the seed's line, the time, and a hash for what else a dart has."""
    rolls = mix(seeds ^ (cells.astype(U64) + U64(1)) * U64(0xD6E8FEB86659FD93))
    table = CELLS[length]
    chance = (rolls >> U64(11)).astype(float) * 2.0**-53
    some = np.flatnonzero(chance >= table[0])
    counts = np.searchsorted(table, chance[some], "right")
    which = np.repeat(some, counts)
    number = np.arange(len(which)) - np.repeat(spans(counts)[:-1], counts)
    darts = mix(rolls[which] + U64(0x9E3779B97F4A7C15) * (number + 1).astype(U64))
    start = low if np.isscalar(low) else low[which]
    return lines[which], start + length * (darts >> U64(11)).astype(float) * 2.0**-53, mix(darts)


def signatures(elements: np.ndarray, weights: np.ndarray, edges: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """DartMinHash signatures of weighted sets, as t 16-bit prints each; sets without weight have zeros.

    elements: 64-bit hashes; weights: positive; edges: of the sets among them.
    """
    n = len(edges) - 1
    totals = np.add.reduceat(np.append(weights, 0.0), edges[:-1]) * (np.diff(edges) > 0)
    result = np.zeros((n, t), np.uint16)
    # Layers of one unit of weight: the last one of an element may be cut.
    layers = np.ceil(weights).astype(np.int64)
    at = np.repeat(np.arange(len(elements)), layers)
    layer = np.arange(len(at)) - np.repeat(spans(layers)[:-1], layers)
    owner = np.repeat(np.arange(n), np.diff(edges))[at]
    seeds = mix(elements[at] ^ mix(layer.astype(U64)))
    room = weights[at] - layer  # of this layer's unit of weight, what the element has
    todo, factor = np.flatnonzero(totals > 0), 1.0
    while len(todo):
        until = np.zeros(n)
        until[todo] = factor * (np.log(t) + 2) * t / totals[todo]  # darts for each unit of weight
        mine = np.flatnonzero(until[owner] > 0)
        found = []
        for cell, (low, high) in enumerate(pairwise(HEADS)):
            mine = mine[until[owner[mine]] > low]
            found.append(_darts(seeds[mine], np.full(len(mine), cell), low, high - low, mine))
        # Then as many cells of one dart as each element needs, all together.
        mine = mine[until[owner[mine]] > HEADS[-1]]
        cells = np.ceil(until[owner[mine]] - HEADS[-1]).astype(np.int64)
        number = np.arange(cells.sum()) - np.repeat(spans(cells)[:-1], cells)
        mine = np.repeat(mine, cells)
        found.append(_darts(seeds[mine], len(HEADS) + number, HEADS[-1] + number, 1.0, mine))
        line, when, rest = (np.concatenate([f[i] for f in found]) for i in range(3))
        hit = (when <= until[owner[line]]) & ((rest >> U64(32)).astype(float) * 2.0**-32 < room[line])
        who, when, rest = owner[line[hit]], when[hit], rest[hit]
        slot = who * t + (rest & U64(0xFFFF)).astype(np.int64) % t
        order = np.lexsort((when, slot))
        slot, rest = slot[order], rest[order]
        new = np.ones(len(slot), bool)
        new[1:] = slot[1:] != slot[:-1]
        chosen, earliest = slot[new], rest[new]
        full = np.bincount(chosen // t, minlength=n) == t
        take = full[chosen // t]
        result.reshape(-1)[chosen[take]] = (mix(earliest[take]) >> U64(48)).astype(np.uint16)
        todo, factor = todo[~full[todo]], 2 * factor  # an empty coordinate: throw for twice the time
    return result


def _signed(batches: Iterator[pa.RecordBatch], words: int, counted: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(2).to_pylist()]
        prints: list[bytes | None] = []
        sizes: list[int] = []
        for part in blocks(texts, BLOCK):
            elements, weights, edges = shingles(texts[part], words, counted)
            rows = signatures(elements, weights, edges)
            prints += [row.tobytes() if b > a else None for row, a, b in zip(rows, edges[:-1], edges[1:])]
            sizes += np.diff(edges).tolist()
        columns = [batch.column(0), batch.column(1), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "prints", "size"])


def _agreeing(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose prints agree on that share of coordinates."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(batch.num_rows, -1) for i in (2, 3))
        good = pa.array((left == right).mean(1) >= least)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(good)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The weighted Jaccard similarity of two sets of (ascending elements, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    both = b[0][at] == a[0]
    shared = np.minimum(a[1][both], b[1][at[both]]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def _similar(batches: Iterator[pa.RecordBatch], words: int, counted: bool, least: float) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose texts have that similarity."""
    for batch in batches:
        left, right = ([t or "" for t in batch.column(i).to_pylist()] for i in (2, 3))
        good: list[bool] = []
        for part in blocks([x + y for x, y in zip(left, right)], BLOCK):
            different = {t: i for i, t in enumerate(dict.fromkeys(left[part] + right[part]))}
            elements, weights, edges = shingles(list(different), words, counted)
            sets = [(elements[a:b], weights[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            good += [similarity(sets[different[x]], sets[different[y]]) >= least for x, y in zip(left[part], right[part])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def band_keys(prints: str = "prints") -> Column:
    """An array with a key for each band of a signature."""
    width = 2 * ROWS
    return F.array(*(F.xxhash64(F.lit(i), F.substring(prints, width * i + 1, width)) for i in range(BANDS)))


def least_estimate(similarity: float) -> float:
    """The share of coordinates on which two texts of at least that similarity agree, but for one pair in a billion."""
    return similarity - DEVIATIONS * float(np.sqrt(similarity * (1 - similarity) / COORDINATES))


def _candidates(i: int, parts: np.ndarray, sides: np.ndarray, prints: np.ndarray, band: int, least: float) -> np.ndarray:
    """The later members of a bucket that are in another component than the i-th and whose prints agree with its own on
    that share of coordinates.

    Sides are 0 in a bucket or block that is compared with itself, or 1 and 2 in two blocks that are compared with each
    other. A pair that shares several bands is found in the first of them only.
    """
    apart = (parts[i + 1 :] != parts[i]) & ((sides[i] == 0) | (sides[i + 1 :] != sides[i]))
    rest = np.flatnonzero(apart) + i + 1
    near = rest[np.count_nonzero(prints[rest] == prints[i], axis=1) >= least * prints.shape[1]]
    if band > 0:
        words = prints.view("<u8")  # ROWS prints are one word: the bands come first
        near = near[~(words[near, :band] == words[i, :band]).any(1)]
    return near


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """The columns key, band, id, component, side, prints (and text) of one bucket after the other; rows come in order."""

    def each(columns: list) -> Iterator[list]:
        key = columns[0]
        edges = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        for a, b in zip(edges[:-1], edges[1:]):
            yield [c[a:b] for c in columns]

    kept: list | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns: list = [batch.column(i).to_numpy() for i in range(5)]
        columns.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), "<u2").reshape(batch.num_rows, -1))
        if batch.num_columns > 6:
            columns.append(np.array(batch.column(6).to_pylist(), object))
        if kept is not None:
            columns = [np.concatenate(pair) for pair in zip(kept, columns)]
        last = int(np.searchsorted(columns[0], columns[0][-1]))  # the last bucket may go on in the next batch
        if last:
            yield from each([c[:last] for c in columns])
        kept = [c[last:] for c in columns]
    if kept is not None:
        yield from each(kept)


def _involved(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The rows key, band, id, component and side of members that have a candidate in their bucket."""
    for key, band, ids, parts, sides, prints in _buckets(batches):
        some = np.zeros(len(ids), bool)
        for i in range(len(ids) - 1):
            near = _candidates(i, parts, sides, prints, int(band[0]), least)
            some[near] = True
            some[i] |= len(near) > 0
        if some.any():
            columns = [pa.array(c[some]) for c in (key, band, ids, parts, sides)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "band", "id", "component", "side"])


def _joined(
    batches: Iterator[pa.RecordBatch], words: int, counted: bool, similarity: float, least: float
) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that tie the similar members of each bucket together: no more than the bucket has members.

    A candidate is compared exactly, by its shingles, unless links found before have put both into one component.
    """
    for _, band, ids, parts, sides, prints, texts in _buckets(batches):
        found: list[np.ndarray] = []
        sets = [shingles(list(texts[part]), words, counted) for part in blocks(list(texts), BLOCK)]
        values, at = np.unique(np.concatenate([x[0] for x in sets]), return_inverse=True)
        weights = np.concatenate([x[1] for x in sets])
        edges = spans(np.concatenate([np.diff(x[2]) for x in sets]))
        totals = np.add.reduceat(np.append(weights, 0.0), edges[:-1]) * (np.diff(edges) > 0)
        own, parts = np.zeros(len(values)), parts.copy()
        for i in range(len(ids) - 1):
            near = _candidates(i, parts, sides, prints, int(band[0]), least)
            if not len(near):
                continue
            mine = slice(edges[i], edges[i + 1])
            own[at[mine]] = weights[mine]
            sizes = np.diff(edges)[near]
            both = gathered(edges[near], sizes)
            shared = np.minimum(weights[both], own[at[both]])
            shared = np.bincount(np.repeat(np.arange(len(near)), sizes), shared, len(near))
            own[at[mine]] = 0.0
            for j in near[shared >= similarity * (totals[near] + totals[i] - shared)].tolist():
                if parts[j] != parts[i]:
                    found.append(np.array([ids[i], ids[j]]))
                    parts[parts == parts[j]] = parts[i]
        if found:
            pairs = np.stack(found)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, counted: bool = False, bucket: int = BUCKET
) -> DataFrame:
    """doc_id, digest of the text, class_id and group_id of every row with a doc_id.

    class_id: the smallest doc_id with the same text; group_id: the smallest doc_id that is reached over texts of at
    least that similarity. A null text counts as empty; texts without words are near-duplicates of equal ones only.
    Rows without a doc_id are left out. Rows that repeat a doc_id with another text are texts of their own, and rows that
    repeat both stay as they are. An empty table gives no rows. Other columns are not read.
    """
    estimate = least_estimate(similarity)
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "coalesce(text, '') AS text").where("doc_id IS NOT NULL")
    rows = rows.select("doc_id", digest("text").alias("digest"), "text")
    signed = settled(
        rows.mapInArrow(lambda b: _signed(b, words, counted), "doc_id LONG, digest BINARY, prints BINARY, size LONG"), "signed"
    )
    # A class goes by its digest until the end, as one doc_id can have several texts.
    first = [F.first(c).alias(c) for c in ("prints", "size")]
    classes = signed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *first)
    # Numbers are given when the table is written, and read from it ever after.
    classes = settled(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    weight = F.ceil((F.col("size") + 1) / SHINGLES).alias("weight")
    members = classes.where("prints IS NOT NULL").select("id", weight, F.posexplode(band_keys()).alias("band", "key"))
    crowded = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = settled(members.join(crowded, "key"), "members")

    prints = classes.select("id", "prints")
    texts = rows.select("doc_id", "digest", "text")

    def texts_of(ids: DataFrame) -> DataFrame:
        """One text of each of these classes, found by its smallest doc_id."""
        needed = ids.distinct().join(classes, "id").select("id", "doc_id", "digest")
        return settled(texts.join(needed, ["doc_id", "digest"]).dropDuplicates(["id"]).select("id", "text"), "texts")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of different pairs (a, b) whose texts are similar."""
        known = pairs.join(prints.select(F.col("id").alias("a"), F.col("prints").alias("x")), "a").join(
            prints.select(F.col("id").alias("b"), F.col("prints").alias("y")), "b"
        )
        near = settled(known.select("a", "b", "x", "y").mapInArrow(lambda b: _agreeing(b, estimate), "a LONG, b LONG"), "near")
        found = texts_of(near.select(F.col("a").alias("id")).union(near.select("b")))
        both = near.join(found.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(
            found.select(F.col("id").alias("b"), F.col("text").alias("y")), "b"
        )
        checked = both.select("a", "b", "x", "y").mapInArrow(lambda b: _similar(b, words, counted, similarity), "a LONG, b LONG")
        return settled(checked, "links")

    def led(crowd: DataFrame) -> DataFrame:
        """Each member of a bucket with the bucket's leader: the one that shares buckets with most others."""
        standing = crowd.groupBy("id").agg(F.sum("n").alias("standing"))
        crowd = crowd.join(standing, "id")
        leaders = crowd.groupBy("key").agg(F.max(F.struct("standing", F.xxhash64("id"), "id")).alias("top"))
        pairs = crowd.select("key", "id").join(leaders.select("key", F.col("top.id").alias("leader")), "key").where("id <> leader")
        return pairs.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()

    def mixed(crowd: DataFrame) -> DataFrame:
        """The rows of buckets with more than one component in them, and the buckets' weights."""
        of_key = crowd.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.sum("weight").alias("n")
        )
        return crowd.join(of_key.where("low <> high").select("key", "n"), "key")

    def in_blocks(crowd: DataFrame) -> DataFrame:
        """The rows of large buckets, once for each pair of blocks that their block is in.

        A component of a block or more has blocks of its own, which are not compared with each other.
        """
        sized = crowd.groupBy("key", "component").agg(F.sum("weight").alias("mine"))
        others = sized.where(F.col("mine") < bucket).groupBy("key").agg(F.sum("mine").alias("others"))
        alone = F.col("mine") >= bucket
        cuts = F.ceil(F.when(alone, F.col("mine")).otherwise(F.col("others")) / bucket)
        sized = sized.join(others, "key", "left").select(
            "key", "component", F.when(alone, F.col("component")).alias("only"), cuts.alias("cuts")
        )
        block = F.xxhash64("only", F.isnull("only"), "number")
        known = sized.select("key", "only", "cuts").distinct()
        known = known.select("key", "only", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("number"))
        known = settled(known.select("key", "only", block.alias("block")), "blocks")
        left, right = known.toDF("key", "only_a", "a"), known.toDF("key", "only_b", "b")
        pairs = left.join(right, "key").where("a <= b AND NOT coalesce(only_a = only_b, false)")
        pairs = pairs.select("key", "a", "b", F.xxhash64("key", "a", "b").alias("task"))
        sides = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("block"), F.lit(0).alias("side")))).otherwise(
            F.array(*(F.struct(F.col(c).alias("block"), F.lit(i).alias("side")) for i, c in ((1, "a"), (2, "b"))))
        )
        placed = crowd.join(sized, ["key", "component"]).withColumn("number", F.pmod(F.xxhash64("id"), F.col("cuts")))
        placed = placed.select("key", "band", "id", "component", block.alias("block"))
        return placed.join(pairs.select("key", "task", F.inline(sides)), ["key", "block"]).select(
            F.col("task").alias("key"), "band", "id", "component", "side"
        )

    def ordered(rows: DataFrame) -> DataFrame:
        """The rows of each bucket one after the other."""
        return rows.repartition(partitions(docs), "key").sortWithinPartitions("key", "side", "id")

    def across(group: DataFrame) -> DataFrame:
        """Links that tie together members of one bucket but of different components.

        Signatures are compared first, and only members whose signature is like another's get their text, once for each
        bucket. Pairs are compared where their bucket is, and never become rows.
        """
        placed = members.drop("n").join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
        crowd = settled(mixed(placed).select("key", "band", "id", "component", "weight", "n"), "mixed")
        rows = crowd.where(F.col("n") <= bucket).select("key", "band", "id", "component", F.lit(0).alias("side"))
        large = crowd.where(F.col("n") > bucket)
        if large.take(1):
            rows = rows.unionByName(in_blocks(large))
        row = "key LONG, band INT, id LONG, component LONG, side INT"
        signed_rows = rows.join(prints, "id").select("key", "band", "id", "component", "side", "prints")
        some = settled(ordered(signed_rows).mapInArrow(lambda b: _involved(b, estimate), row), "involved")
        known = some.join(prints, "id").join(texts_of(some.select("id")), "id")
        known = ordered(known.select("key", "band", "id", "component", "side", "prints", "text"))
        links = known.mapInArrow(lambda b: _joined(b, words, counted, similarity, estimate), "a LONG, b LONG")
        return settled(links, "links")

    tried = settled(led(members), "led")
    links = linked(tried)
    group = settled(components(links), "components")
    more = across(group)
    if more.take(1):
        group = settled(components(links.union(more)), "components")
    smallest = group.join(classes, "id").groupBy("component").agg(F.min("doc_id").alias("group_id"))
    named = group.join(smallest, "component").select("id", "group_id")
    of_class = classes.join(named, "id", "left").select(
        "digest", F.col("doc_id").alias("class_id"), F.coalesce("group_id", "doc_id").alias("group_id")
    )
    return signed.select("doc_id", "digest").join(of_class, "digest").select("doc_id", "digest", "class_id", "group_id")
