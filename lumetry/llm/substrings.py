"""Substring de-duplication by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash of the last sixteen bytes is low, and at the end
of a line. So the cuts depend on what stands around them only, and a passage is cut alike wherever it stands and whatever
was inserted before. Chunks are de-duplicated by digest: of equal chunks the first one (lowest doc_id, then place) counts as
the original.

Chunks of a text that follow each other as their originals do in one other text are a piece of one repeat. Whatever part
of a chunk belongs to the repeat as well is found from the texts themselves: at both ends of a piece the bytes are compared
with those around its original, so a piece also grows over chunks whose own original stands elsewhere. Pieces that meet in
the same place of the same text are one repeat, others are not, however close they stand; repeats of fewer than fifty words
are left alone.

A repeat is found if some chunk that lies in it whole has its original in a text that holds the repeat. Fifty words of 300
bytes hold no whole chunk with a probability of about one in a thousand where no line ends in them, those of 200 bytes with
one of about one in seventy; a repeat all of whose chunks stand in still earlier texts, each in another place, is missed too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, WORD_BYTE, blocks, fresh, gathered, mix, settled, span_hashes, spans, working_tables

ROLL = 16  # bytes that the gear hash looks back
MEAN_CHUNK = 32  # bytes between two cuts, on average
CLOSE = 4  # a cut at most so many bytes after another is none, but at the end of a line
LONGEST_CHUNK = 256  # where no cut comes, as in a word said over and over, one is made after so many bytes
LEAST_WORDS = 50  # repeats of fewer words stay
CONTEXT = 256  # bytes around an original that a piece can be continued into: the longest chunk, or eight of the mean length
HOT = 200  # a chunk that makes up more than this share (one of so many) of all repeated ones is joined in as many shares
BLOCK = 1 << 18
REMOVED, SPANS = "removed_words", "removed_spans"

GEAR = mix(np.arange(256, dtype=U64) + U64(0x67656172))  # a table of random numbers, one for each byte value


def gear_cuts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The first bytes of all chunks of the texts with these edges."""
    if not len(data):
        return np.zeros(0, np.int64)
    rolled = GEAR[data]
    step = 1
    while step < ROLL:  # the hash of the last 2 * step bytes from those of the last step bytes
        rolled[step:] = (rolled[:-step] << U64(step)) + rolled[step:]
        step *= 2
    # Bits from ROLL - 1 up have seen all ROLL bytes. mix makes every bit of the threshold count.
    low = mix(rolled & U64(0xFFFFFFFF)) < U64(2**64 // MEAN_CHUNK)
    at = np.flatnonzero(low) + 1
    text = np.searchsorted(edges, at, "right") - 1
    first = edges[np.minimum(text, len(edges) - 2)]
    at = at[(at - first >= ROLL) & (at < edges[-1])]
    if len(at):
        at = at[np.diff(at, prepend=-CLOSE - 1) > CLOSE]
    lines = np.flatnonzero(data[:-1] == 10) + 1
    first = np.zeros(len(data) + 1, bool)
    first[at] = first[lines] = first[edges[:-1]] = True
    starts = np.flatnonzero(first[:-1])
    more = (np.diff(starts, append=len(data)) - 1) // LONGEST_CHUNK
    long = np.flatnonzero(more)
    if len(long):
        added = gathered(np.ones(len(long), np.int64), more[long]) * LONGEST_CHUNK + np.repeat(starts[long], more[long])
        starts = np.union1d(starts, added)
    return starts


# The place of a chunk as one number, in whose order chunks of a text stand: its first byte, its length, the words that begin
# in it, and those in the chunk before and after it (NO_CHUNK where there is none).
NO_CHUNK = 255
START, LENGTH = "shiftright(place, 33)", "(shiftright(place, 24) & 511)"
WORDS, BEFORE, AFTER = ("(shiftright(place, 16) & 255)", "(shiftright(place, 8) & 255)", "(place & 255)")


def chunk_places(data: np.ndarray, edges: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    lengths = np.diff(np.append(starts, len(data)))
    inside = WORD_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges[:-1][edges[:-1] < len(data)]] = inside[edges[:-1][edges[:-1] < len(data)]]
    words = np.add.reduceat(begins, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    before, after = np.full(len(starts), NO_CHUNK), np.full(len(starts), NO_CHUNK)
    same = np.flatnonzero(owner[1:] == owner[:-1])
    before[same + 1], after[same] = words[same], words[same + 1]
    return (starts - edges[owner]) << 33 | lengths << 24 | words << 16 | before << 8 | after


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, ties = (batch.column(i).to_numpy() for i in (0, 1))
        texts = batch.column(2).to_pylist()
        for part in blocks(texts, BLOCK):
            encoded = [t.encode() for t in texts[part]]
            edges = spans(np.fromiter(map(len, encoded), np.int64, len(encoded)))
            data = np.frombuffer(b"".join(encoded), np.uint8)
            starts = gear_cuts(data, edges)
            ends = np.append(starts[1:], len(data))
            owner = np.searchsorted(edges, starts, "right") - 1
            columns = [span_hashes(data, starts, ends).view(np.int64), ids[part][owner], ties[part][owner]]
            columns.append(chunk_places(data, edges, starts, owner))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["digest", "id", "tie", "place"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes before or after the wanted places of a text."""
    for batch in batches:
        found = []
        for of, tie, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = text.encode()
            for w in wanted:
                at = w["at"]
                found.append((of, tie, at, w["before"], data[max(0, at - CONTEXT) : at] if w["before"] else data[at : at + CONTEXT]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["of", "of_tie", "at", "before", "context"])


def _common(a: bytes, b: bytes) -> int:
    """The length of the longest common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax())


def _is_word(data: bytes, at: int) -> bool:
    return 0 <= at < len(data) and bool(WORD_BYTE[data[at]])


def _words(data: bytes) -> int:
    inside = WORD_BYTE[np.frombuffer(data, np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + (len(inside) > 0 and inside[0]))


def repeats(data: bytes, ends: list[dict], least: int) -> list[tuple[int, int]]:
    """The spans of bytes to remove: pieces, continued as far as their original goes on alike, joined where they meet on
    the same original, cut back to whole words, and only those of at least so many words.

    ends: two for the pieces of one original, with its text (of, of_tie), first byte (origin) and length, the first bytes of
    the pieces (firsts), and `before` with the bytes before the original, or not `before` with those after it.
    """
    pieces: dict[tuple, list[int]] = {}
    for end in ends:
        context = end["context"] or b""
        for first in end["firsts"]:
            last = first + end["length"]
            piece = pieces.setdefault((end["of"], end["of_tie"], end["origin"] - first, first, last), [first, last])
            if end["before"]:
                piece[0] = first - _common(data[max(0, first - CONTEXT) : first][::-1], context[::-1])
            else:
                piece[1] = last + _common(data[last : last + CONTEXT], context)
    found: list[list[int]] = []
    now = None
    for (*origin, _, _), (first, last) in sorted(pieces.items(), key=lambda item: (item[0][:3], item[1])):
        if origin == now and first <= found[-1][1]:
            found[-1][1] = max(found[-1][1], last)
        else:
            found.append([first, last])
        now = origin
    result: list[tuple[int, int]] = []
    for first, last in sorted(found):
        while first < last and _is_word(data, first) and _is_word(data, first - 1):
            first += 1
        while first < last and _is_word(data, last - 1) and _is_word(data, last):
            last -= 1
        if first < last and _words(data[first:last]) >= least:
            if result and first <= result[-1][1]:
                result[-1] = (result[-1][0], max(result[-1][1], last))
            else:
                result.append((first, last))
    # Where words stand on both sides, what parts them stays.
    return [(first + (_is_word(data, first - 1) and _is_word(data, last)), last) for first, last in result]


def without(data: bytes, cuts: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for first, last in cuts:
        parts.append(data[at:first])
        at = last
    return b"".join([*parts, data[at:]]).decode()


def repeated_pieces(rows: DataFrame, least: int) -> DataFrame:
    """The ends of pieces of repeats in texts (id, tie, text): id, tie, of, of_tie, origin, length, firsts, before, at.

    of, of_tie, origin: the original's text and first byte; firsts: those of all pieces of the text that repeat just this
    original, as the periods of words said over and over do; at: the original's first byte if `before`, or else its last + 1,
    null where the pieces are at the edge of their text.
    """
    # The tables of chunks are of no use once the pieces are written, which are few beside them.
    with working_tables(rows.sparkSession):
        return settled(_pieces(rows, least), "pieces", keep=True)


def _pieces(rows: DataFrame, least: int) -> DataFrame:
    kinds = "digest LONG, id LONG, tie LONG, place LONG"
    chunks = rows.mapInArrow(_chunks, kinds)
    # A common chunk is folded to one row in each task before the shuffle.
    shared = chunks.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("of")).where("n > 1")
    shared = settled(shared, "shared")
    # No more than HOT chunks are so common: the rows of those are joined in as many shares.
    total = shared.agg(F.sum("n")).first()[0] or 0
    common = F.broadcast(shared.where(F.col("n") * HOT > total).select("digest", F.lit(True).alias("hot")))
    share = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "tie", "place"), F.lit(HOT))).otherwise(F.lit(0)).cast("int")
    shares = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(HOT - 1))).otherwise(F.array(F.lit(0)))

    def dealt(table: DataFrame) -> DataFrame:
        return table.join(common, "digest", "left").select(*table.columns, share.alias("share"))

    def spread(table: DataFrame) -> DataFrame:
        return table.join(common, "digest", "left").select(*table.columns, F.explode(shares).alias("share"))

    copies = dealt(chunks).join(spread(shared.drop("n")).hint("shuffle_hash"), ["digest", "share"])
    copies = settled(copies, "copies")
    originals = copies.where("id = of").groupBy("digest").agg(F.min(F.struct("tie", "place")).alias("first"))
    start = F.expr(START)
    originals = originals.select("digest", F.col("first.tie").alias("of_tie"), F.expr(START.replace("place", "first.place")).alias("at"))
    originals = settled(originals, "originals")
    own = (F.col("id") == F.col("of")) & (F.col("tie") == F.col("of_tie"))
    copies = copies.join(spread(originals), ["digest", "share"]).where(~(own & (start == F.col("at"))))
    # Rows that repeat both doc_id and text are one text here.
    copies = copies.select("id", "tie", "place", "of", "of_tie", "at").repartition("id", "tie")
    copies = copies.groupBy("id", "tie", "place").agg(*(F.min(c).alias(c) for c in ("of", "of_tie", "at")))
    last = (start + F.expr(LENGTH)).alias("last")
    copies = copies.select(
        "id", "tie", "of", "of_tie", start.alias("first"), last, (F.col("at") - start).alias("shift"),
        F.expr(WORDS).alias("words"), F.expr(BEFORE).alias("words_before"), F.expr(AFTER).alias("words_after"),
    )
    order = Window.partitionBy("id", "tie").orderBy("first")
    meets = F.coalesce(F.lag("last").over(order) == F.col("first"), F.lit(False))
    same = meets & F.coalesce(F.lag(F.struct("of", "of_tie", "shift")).over(order) == F.struct("of", "of_tie", "shift"), F.lit(False))
    numbered = copies.withColumn("opens", (~meets).cast("int")).withColumn("turns", (~same).cast("int"))
    numbered = numbered.withColumn("run", F.sum("opens").over(order)).withColumn("piece", F.sum("turns").over(order))
    # A repeat lies in a run of repeated chunks and those next to it: with too few words in all, there is none.
    of_run = Window.partitionBy("id", "tie", "run")
    edge = F.when(F.col("words_before") < NO_CHUNK, F.col("words_before")).otherwise(0)
    rim = F.when(F.col("words_after") < NO_CHUNK, F.col("words_after")).otherwise(0)
    room = F.sum("words").over(of_run) + F.min_by(edge, "first").over(of_run) + F.max_by(rim, "first").over(of_run)
    numbered = numbered.withColumn("room", room).where(F.col("room") >= least)
    pieces = numbered.groupBy("id", "tie", "piece").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        *(F.first(c).alias(c) for c in ("of", "of_tie", "shift")),
        F.min_by("words_before", "first").alias("words_before"),
        F.max_by("words_after", "first").alias("words_after"),
    )
    # Where the text ends there is nothing to continue. The texts are dealt out already: this shuffles nothing.
    origin, length = F.col("first") + F.col("shift"), F.col("last") - F.col("first")
    head = F.when(F.col("words_before") < NO_CHUNK, origin)
    tail = F.when(F.col("words_after") < NO_CHUNK, origin + length)
    of_original = ("id", "tie", "of", "of_tie", origin.alias("origin"), length.alias("length"), head.alias("head"), tail.alias("tail"))
    pieces = pieces.groupBy(*of_original).agg(F.collect_list("first").alias("firsts"))
    ends = F.array(
        F.struct(F.lit(True).alias("before"), F.col("head").alias("at")),
        F.struct(F.lit(False).alias("before"), F.col("tail").alias("at")),
    )
    return pieces.withColumn("end", F.explode(ends)).select(
        "id", "tie", "of", "of_tie", "origin", "length", "firsts", "end.before", "end.at"
    )


def _completed(rows: DataFrame, pieces: DataFrame, repeated: bool) -> DataFrame:
    """The ends with the bytes before or after their originals (context). repeated: rows may repeat both id and tie."""
    # The bytes at each place are looked up once, however many repeat it. This join and the one with the texts to rewrite deal
    # the texts out alike, so Spark shuffles them once.
    place = ["of", "of_tie", "at", "before"]
    wanted = pieces.where("at IS NOT NULL").select(*place).distinct()
    wanted = wanted.groupBy(F.col("of").alias("id"), F.col("of_tie").alias("tie")).agg(F.collect_list(F.struct("at", "before")).alias("wanted"))
    texts = rows.join(wanted, ["id", "tie"]).select("id", "tie", "text", "wanted")
    if repeated:
        texts = texts.dropDuplicates(["id", "tie"])  # however many rows repeat an original, each end meets it once
    contexts = texts.mapInArrow(_contexts, "of LONG, of_tie LONG, at LONG, before BOOLEAN, context BINARY")
    return pieces.join(contexts, place, "left")


def _rewritten(batches: Iterator[pa.RecordBatch], at: int, least: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Texts without their repeats; the last two columns are the number of removed words and the spans."""
    for batch in batches:
        texts, ends = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        counts, found = [0] * len(texts), [[] for _ in texts]
        for i, (text, own) in enumerate(zip(texts, ends)):
            if not text or not own:
                continue
            data = text.encode()
            cuts = repeats(data, own, least)
            if cuts:
                texts[i] = without(data, cuts)
                counts[i] = sum(_words(data[a:b]) for a, b in cuts)
                found[i] = [{"first": a, "last": b} for a, b in cuts]
        columns = [batch.column(k) for k in range(batch.num_columns - 1)]
        columns[at] = pa.array(texts, batch.schema.field(at).type)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(found, kind)], names=names)


def deduplicated(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """`docs` with all columns, the text without repeats, and two more, the last: REMOVED, the number of words taken out, and
    SPANS, where they stood (bytes, first and last + 1). Where `docs` has columns of these names, the new ones begin with an
    underscore, or as many as it takes.

    What is taken out repeats, byte by byte and as one passage of at least so many words, text that stands at an earlier
    place (lower doc_id, or before in the same text); a copy of a whole text leaves an empty one. Texts without a doc_id
    come last. Rows that repeat a doc_id with another text are texts of their own, in the order of a hash of the text; rows
    that repeat both are one text, and get the same result. A null or empty text stays. Cuts are never made inside words.
    """
    taken = docs.columns
    removed, found, id_, tie, ends = (fresh(name, taken) for name in (REMOVED, SPANS, "id", "tie", "ends"))
    at = next(i for i, name in enumerate(taken) if name.lower() == "text")
    known = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias(id_))
    # Where every row has a doc_id of its own, which one look at the ids tells, nothing else is needed to know a text by.
    repeated = known.groupBy(id_).agg(F.count("*").alias("n")).where("n > 1").take(1)
    known = known.withColumn(tie, F.xxhash64("text") if repeated else F.lit(0).cast("long"))
    rows = known.where(F.col("text") != "").select(F.col(id_).alias("id"), F.col(tie).alias("tie"), F.col("text").alias("text"))
    pieces = repeated_pieces(rows, least)
    completed = _completed(rows, pieces, bool(repeated))
    end = F.struct("of", "of_tie", "origin", "length", "firsts", "before", "context")
    of_text = completed.groupBy(F.col("id").alias(id_), F.col("tie").alias(tie)).agg(F.collect_list(end).alias(ends))
    ordered = known.join(of_text, [id_, tie], "left").select(*(F.col(f"`{name}`") for name in taken), ends)
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField(removed, T.LongType()), T.StructField(found, T.ArrayType(span))])
    return ordered.mapInArrow(lambda batches: _rewritten(batches, at, least, schema.names), schema)
