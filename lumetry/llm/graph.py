"""Connected components of links between ids, without gathering any of them in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


class Joined:
    """Components of positions 0..n-1 under growing links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            roots = self.roots()
            x, y = roots[a], roots[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


FOLD = 1 << 22  # links folded together


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task, some millions at a time, as one for each id: to the smallest id that it reaches over them."""
    held: list[pa.RecordBatch] = []

    def fold() -> pa.RecordBatch:
        a, b = (np.concatenate([batch.column(i).to_numpy() for batch in held]) for i in (0, 1))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        joined = Joined(len(ids))
        joined.link(at[: len(a)], at[len(a) :])
        roots = joined.roots()
        some = np.flatnonzero(roots != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[roots[some]])], names=["u", "v"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= FOLD:
            yield fold()
            held.clear()
    if held:
        yield fold()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in the columns a and b of `links`; component is the smallest id reachable.

    Every task folds its own links to stars; large-star and small-star steps (Kiveris et al., 2014) then tie ids to the
    smallest neighbour seen, again and again until nothing changes, which takes few rounds. Each round is written out,
    and ids with very many links are no hot spot beyond a join that Spark can split: minima are folded before the shuffle.
    """
    given = links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    stars = settled(given.mapInArrow(_folded, "u LONG, v LONG"), "stars")
    seen = None
    while True:
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = settled(small.union(least).distinct().mapInArrow(_folded, "u LONG, v LONG"), "stars")
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())
