"""Token ids of a corpus in files of directly addressable codes.

Every id is split into chunks of eight bits. Level k holds the k-th chunk of all ids that have one, and a bitmap says
which of them continue on the next level; a rank directory over the bitmap (ones before each 512 bits) finds the place
there. So any token is read by a few look-ups, without decoding what stands before it.

A file set is Parquet with one segment of codes in a row: the part (a range of doc_id) and place of the segment, the
first token's place in its part, the documents in it with their lengths, and the codes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, partitions
from .tokens import encode_with_end

MAGIC = b"DAC1"
PER_RANK = 512  # bits between two entries of a rank directory
SEGMENT_CHARS = 1 << 22  # a segment is closed when its texts reach this; a longer text is a segment of its own

SEGMENTS = "part INT, segment INT, first LONG, n_tokens LONG, doc_ids ARRAY<LONG>, lengths ARRAY<LONG>, codes BINARY"
READ = "doc_id LONG, start LONG, n_tokens LONG, ids_crc32 LONG, first_id LONG, middle_id LONG"


def encode_codes(ids: np.ndarray) -> bytes:
    """Directly addressable codes of non-negative ids below 2**32."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        more = rest > 255
        bits = np.zeros(-(-len(rest) // PER_RANK) * PER_RANK // 8, np.uint8)
        packed = np.packbits(more, bitorder="little")
        bits[: len(packed)] = packed
        ones = np.bitwise_count(bits.view("<u8")).reshape(-1, PER_RANK // 64).sum(1, dtype=np.uint64)
        ranks = np.zeros(len(ones) + 1, "<u4")
        ranks[1:] = np.cumsum(ones)
        levels.append(
            struct.pack("<QQ", len(rest), len(ranks)) + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes()
        )
        if not more.any():
            break
        rest = rest[more] >> 8
    return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)


class Codes:
    """Reads what encode_codes wrote."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = 8
        for _ in range(struct.unpack_from("<I", data, 4)[0]):
            n, n_ranks = struct.unpack_from("<QQ", data, at)
            at += 16
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            size = -(-n // PER_RANK) * PER_RANK // 8
            bits = np.frombuffer(data, np.uint8, size, at)
            at += size
            ranks = np.frombuffer(data, "<u4", n_ranks, at)
            at += 4 * n_ranks
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, places: int | np.ndarray) -> np.ndarray:
        """The ids at these places, each found by itself."""
        place = np.atleast_1d(np.asarray(places, np.int64))
        if len(place) and (place.min() < 0 or place.max() >= len(self)):
            raise IndexError("no such token")
        ids = np.zeros(len(place), np.uint32)
        going = np.arange(len(place))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            ids[going] |= chunks[place].astype(np.uint32) << np.uint32(8 * level)
            more = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            going, place = going[more], place[more]
            if not len(going):
                break
            block = place // PER_RANK
            window = bits.reshape(-1, PER_RANK // 8)[block]
            inside = (place % PER_RANK)[:, None] - 8 * np.arange(PER_RANK // 8)
            masks = (1 << np.clip(inside, 0, 8)) - 1
            place = ranks[block].astype(np.int64) + np.bitwise_count(window & masks.astype(np.uint8)).sum(1, dtype=np.int64)
        return ids

    def all(self) -> np.ndarray:
        """All ids in order."""
        ids = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            here = chunks.astype(np.uint32)
            more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            here[more] |= ids << np.uint32(8)
            ids = here
        return ids


def _segments(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    part, segment, first = TaskContext.get().partitionId(), 0, 0
    schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64())]
        + [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary())]
    )
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for piece in blocks(texts, SEGMENT_CHARS):
            ids, counts = encode_with_end(texts[piece], path)
            values = [[part], [segment], [first], [len(ids)], [doc_ids[piece]], [counts.tolist()], [encode_codes(ids)]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
            segment, first = segment + 1, first + len(ids)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Write the ids of all texts, each followed by id 0, in ascending order of doc_id to `path`.

    A null text counts as empty; null doc_ids come first; rows that repeat a doc_id stand in an order fixed by their
    texts; an empty table gives no segment. Columns other than doc_id and text are not read. `tokenizer`: the file of a
    byte-level BPE where every machine has it (None: the public one).
    """
    tie = F.xxhash64("text")  # rows of one doc_id can go to several tasks, too
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), tie.alias("tie"))
        .repartitionByRange(partitions(docs), F.asc_nulls_first("doc_id"), "tie")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie", F.asc_nulls_first("text"))
        .select("doc_id", "text")
    )
    ordered.mapInArrow(lambda batches: _segments(batches, tokenizer), SEGMENTS).write.parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a file set, `first` counted from the start of the corpus.

    A part's first token is found from the parts' totals: as many rows as the writing stage had tasks, whatever the data.
    """
    rows = spark.read.schema(SEGMENTS).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), "part").withColumn("first", F.col("first") + F.col("base")).drop("base")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes, lengths = Codes(row["codes"]), np.array(row["lengths"], np.int64)
            ids = codes.all().astype("<u4")
            edges = np.concatenate([[0], np.cumsum(lengths)])
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            some = [codes[place].astype(np.int64) for place in (edges[:-1], (edges[:-1] + edges[1:]) // 2)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["first"] + edges[:-1], pa.int64())]
                + [pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()), *map(pa.array, some)],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "first_id", "middle_id"],
            )


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set, from its codes: the place of its first id, its number of ids and their CRC-32; and the
    first id and the one in the middle, each looked up by itself through the ranks."""
    return segments(spark, path).select("doc_ids", "lengths", "first", "codes").mapInArrow(_digests, READ)
