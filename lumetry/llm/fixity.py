"""Fixity audit of WARC replicas with Merkle trees.

Every record is hashed with its place and length. A leaf of a file's tree covers a range of offsets and hashes the
records that begin in it, in order; a node hashes its children in order. Two replicas are compared by the roots of
their files; only under nodes that differ are the next lower ones compared, down to the leaves, and only records of
differing leaves are looked at. All of it is grouping and joining of digests: no content is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

RANGE = 1 << 16  # bytes of offsets under a leaf
FANOUT = 16
FILE_RECORDS = 4096


def warc_record(url: Column, record_id: Column, content: Column) -> Column:
    """The text of a WARC response record."""
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
        F.octet_length(F.coalesce(content, F.lit(""))).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, F.coalesce(content, F.lit("")), F.lit("\r\n\r\n"))


def records(pages: DataFrame, per_file: int = FILE_RECORDS) -> DataFrame:
    """file, record_id, offset, length, digest of the records of pages (page_id, url, html), in files of consecutive ids.

    Null urls and contents count as empty; pages without an id form a file of their own (-1). Equal ids stand in the order of their
    digests.
    """
    record = warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    file = F.coalesce(F.floor(F.col("page_id") / per_file).cast("long"), F.lit(-1).cast("long"))
    rows = pages.select(
        file.alias("file"), F.col("page_id").cast("long").alias("record_id"), F.octet_length(record).cast("long").alias("length"),
        F.sha2(F.encode(record, "utf-8"), 256).alias("digest"),
    )
    before = Window.partitionBy("file").orderBy("record_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    return rows.select("file", "record_id", offset.alias("offset"), "length", "digest")


def _hashed(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One digest for each group: of its rows' digests in order. A group has as many rows as a range or node can hold."""
    parts = F.array_sort(F.collect_list(order))
    return rows.groupBy(*keys).agg(F.sha2(F.to_json(parts), 256).alias("digest"))


def tree(replica: DataFrame, height: int) -> list[DataFrame]:
    """The levels of all files' trees from the leaves up: file, node, digest. One table for each level, of which each is
    smaller by the fan-out."""
    leaf = F.floor(F.col("offset") / RANGE).cast("long")
    order = F.struct("offset", "record_id", "length", F.col("digest").alias("content"))
    levels = [settled(_hashed(replica.withColumn("node", leaf), ["file", "node"], order), "leaves")]
    for _ in range(height):
        below = levels[-1].withColumn("parent", F.floor(F.col("node") / FANOUT).cast("long"))
        order = F.struct("node", F.col("digest").alias("content"))
        level = _hashed(below, ["file", "parent"], order).withColumnRenamed("parent", "node")
        levels.append(settled(level, "nodes"))
    return levels


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    both = ours.alias("a").join(theirs.alias("b"), ["file", "node"], "full_outer")
    return both.where(~F.col("a.digest").eqNullSafe(F.col("b.digest"))).select("file", "node")


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """What of the replica `theirs` differs from `ours` (both: file, record_id, offset, length, digest).

    A row for each differing record: file, record_id, offset and length (of ours; of theirs for extra ones), and
    status: corrupt (other content at the same place), moved (equal content elsewhere), missing, or extra. Records
    whose ids repeat in a file are told apart by their offsets. Equal replicas and empty tables give no rows.
    """
    ours, theirs = settled(ours, "ours"), settled(theirs, "theirs")
    last = ours.select("offset").union(theirs.select("offset")).agg(F.max("offset")).first()[0] or 0
    height, nodes = 0, last // RANGE + 1
    while nodes > 1:
        nodes, height = -(-nodes // FANOUT), height + 1
    trees = tree(ours, height), tree(theirs, height)
    differing = settled(_differing(trees[0][height], trees[1][height]), "differing")
    for level in range(height - 1, -1, -1):
        parents = differing.withColumnRenamed("node", "parent")
        a, b = (
            t[level].withColumn("parent", F.floor(F.col("node") / FANOUT).cast("long")).join(parents, ["file", "parent"], "left_semi")
            for t in trees
        )
        differing = settled(_differing(a, b), "differing")
    leaf = F.floor(F.col("offset") / RANGE).cast("long").alias("node")
    suspects = [
        replica.select("*", leaf).join(differing, ["file", "node"], "left_semi").drop("node") for replica in (ours, theirs)
    ]
    twice = Window.partitionBy("file", "record_id").orderBy("offset")
    a, b = (s.withColumn("copy", F.row_number().over(twice)) for s in suspects)
    a = a.select("file", "record_id", "copy", *(F.col(c).alias(f"a_{c}") for c in ("offset", "length", "digest")))
    b = b.select("file", "record_id", "copy", *(F.col(c).alias(f"b_{c}") for c in ("offset", "length", "digest")))
    same = a["file"].eqNullSafe(b["file"]) & a["record_id"].eqNullSafe(b["record_id"]) & (a["copy"] == b["copy"])
    both = a.join(b, same, "full_outer")
    status = (
        F.when(F.col("b_offset").isNull(), "missing").when(F.col("a_offset").isNull(), "extra")
        .when(F.col("a_digest") != F.col("b_digest"), "corrupt").when(F.col("a_offset") != F.col("b_offset"), "moved")
    )
    return both.select(
        F.coalesce(a["file"], b["file"]).alias("file"),
        F.coalesce(a["record_id"], b["record_id"]).alias("record_id"),
        F.coalesce("a_offset", "b_offset").alias("offset"),
        F.coalesce("a_length", "b_length").alias("length"),
        status.alias("status"),
    ).where("status IS NOT NULL")
