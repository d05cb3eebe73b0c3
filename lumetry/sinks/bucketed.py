"""A summary in buckets of its keys, into which later revisions are merged without a shuffle of what is there.

Both the summary and what is new are tables of the catalog with the same buckets, so Spark adds them up bucket by bucket: a
merge, and any other aggregate by the keys, has no exchange. Only what is new is dealt out by key. Each merge writes the
next version of the table and then points the view of its name there, so readers see the old one or the new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.revisions import latest_revision

BUCKETS = 64


def write_bucketed(rows: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Write rows as an external table, a sorted file for each bucket of the keys."""
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return rows.sparkSession.table(name)


def dealt(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows as the buckets want them, so that each task writes one file."""
    return rows.repartition(buckets, *keys)


def merge_bucketed(
    spark: SparkSession, name: str, path: str, revisions: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """The summary `name` with later revisions, which have `run_id` and `batch_id`; made if there is none.

    Give it the revisions of the batches since the last merge. Those are folded to the latest of each key, and then merged
    with the summary bucket by bucket. `buckets` must stay as it was for the first merge.
    """
    newest = latest_revision(dealt(revisions, keys, buckets), keys)
    version = 1
    if spark.catalog.tableExists(name):
        version = 1 + int(spark.table(name).select(F.max("version")).first()[0] or 0)
        fresh = write_bucketed(newest, f"{name}_new", f"{path}/new_{version}", keys, buckets)
        newest = merged(spark.table(name).drop("version"), fresh, keys)
    table = write_bucketed(newest.withColumn("version", F.lit(version)), f"{name}_{version}", f"{path}/{version}", keys, buckets)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_{version}")
    return table.drop("version")


def merged(summary: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest row of each key of two tables with the same buckets: no exchange."""
    return latest_revision(summary.unionByName(fresh), keys)
