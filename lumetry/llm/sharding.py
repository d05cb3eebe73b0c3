"""Sharding by extendible hashing.

A directory is indexed by the first bits of a key's hash. Only a bucket whose documents exceed the byte limit is split
on one more bit, until every shard fits. Sizes are folded to one row for each prefix before they are shuffled; prefixes
are summed for all depths of a few bits at a time, and only rows under prefixes that are still too large are looked at
again with more bits. Hash bits come from MD5, so any tool finds a document's shard from the directory.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

SHARD_BYTES = 1 << 20
BITS = 60  # of a hash, at most: documents that agree on all of them are dealt to pages
STEP = 6  # bits added in a round


def hash_bits(doc_id: str = "doc_id") -> Column:
    """The first BITS bits of the MD5 of the id's text (a null id: of the empty text)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def directory(sizes: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The shards (depth, prefix, n_bytes) of rows (hash, n_bytes), and the greatest depth. Shards over the limit are at
    depth BITS only."""
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    low, depth = 0, min(BITS, max(0, ceil(log2(max(1, total / limit)))) + STEP)
    rows, found = sizes, []
    while True:
        counted = settled(rows.groupBy(F.shiftright("hash", BITS - depth).alias("deep")).agg(F.sum("n_bytes").alias("n_bytes")), "sizes")
        levels = counted.select("n_bytes", "deep", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth"))
        levels = levels.withColumn("prefix", F.expr(f"shiftright(deep, {depth} - depth)"))
        nodes = settled(levels.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("n_bytes")), "nodes")
        # A shard fits, and the bucket that it was split from did not.
        parents = nodes.where(F.col("n_bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        small = nodes.where((F.col("n_bytes") <= limit) | (F.col("depth") == BITS))
        split = small.withColumn("parent", F.shiftright("prefix", 1)).join(parents, ["depth", "parent"], "left_semi")
        found.append(split.select("depth", "prefix", "n_bytes"))
        if low == 0:
            found.append(small.where("depth = 0").select("depth", "prefix", "n_bytes"))
        large = nodes.where((F.col("depth") == depth) & (F.col("n_bytes") > limit))
        if depth == BITS or not large.take(1):
            break
        rows = rows.withColumn("prefix", F.shiftright("hash", BITS - depth))
        rows = rows.join(large.select("prefix"), "prefix", "left_semi").select("hash", "n_bytes")
        low, depth = depth, min(BITS, depth + STEP)
    shards = found[0]
    for more in found[1:]:
        shards = shards.union(more)
    return settled(shards, "directory"), depth


def shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, shard, depth, page and n_bytes of every row: the shard's hash prefix as a text of bits, their number, and
    the bytes of the text.

    The documents of a shard and page have at most `limit` bytes; a longer text is alone in its page or, where its hash
    is like no other, in its shard. page is 0 but for rows that agree on all bits of the hash (such as rows that repeat a
    doc_id) and exceed the limit together: those are numbered where they lie, without gathering them. A null text has 0
    bytes; null ids share a shard's pages. An empty table gives no rows. Other columns are not read.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    sizes = settled(docs.select(F.col("doc_id"), hash_bits().alias("hash"), size), "hashed")
    found, deepest = directory(sizes.select("hash", "n_bytes"), limit)
    # Every row meets the one shard whose prefix it has: shards are told apart by their depths.
    depths = sorted(r[0] for r in found.select("depth").distinct().collect())  # at most BITS + 1 numbers
    tagged = sizes.withColumn("lane", F.explode(F.array(*(F.lit(d) for d in depths)))) if len(depths) > 1 else (
        sizes.withColumn("lane", F.lit(depths[0] if depths else 0))
    )
    tagged = tagged.withColumn("prefix", F.expr(f"shiftright(hash, {BITS} - lane)"))
    own = found.select(F.col("depth").alias("lane"), "prefix", F.col("n_bytes").alias("shard_bytes"))
    joined = tagged.join(own, ["lane", "prefix"])
    full = found.where(F.col("n_bytes") > limit).select(F.col("depth").alias("lane"), "prefix")
    largest = tagged.join(full, ["lane", "prefix"]).groupBy("lane", "prefix").agg(F.max("n_bytes").alias("largest"))
    joined = joined.join(largest, ["lane", "prefix"], "left")
    number = F.monotonically_increasing_id()
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("largest"), F.lit(1))))
    page = F.when(F.col("largest").isNull(), F.lit(0)).otherwise(F.floor(number / per_page)).cast("long")
    shard = F.expr(f"right(lpad(conv(prefix, 10, 2), {BITS}, '0'), lane)")
    return joined.select("doc_id", shard.alias("shard"), F.col("lane").cast("int").alias("depth"), page.alias("page"), "n_bytes")
