"""Tables that grow by whole batches.

A batch is written to folders of its own attempt first and then committed by one small file, which names the attempt.
Readers see attempts that are committed and no others, so a batch that fails halfway is invisible, its second run replaces
it, and all tables of a batch appear together:

    <path>/<table>/run_id=1/batch_id=7/attempt=<id>/...    rows
    <path>/commits/run_id=1/batch_id=7/                    {"attempt": "<id>"}
    <path>/runs/                                           {"run_id": 1, "query_id": "<id>"}

A run is the life of a checkpoint: a query that is started again from its checkpoint goes on with its run, and a new
checkpoint, whose batches count from 0 again, begins the next one. One query at a time writes to a path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

RUNS = "run_id BIGINT, query_id STRING"
COMMITS = "attempt STRING, run_id BIGINT, batch_id BIGINT"
ADAPTIVE = "spark.sql.adaptive.enabled"


class Staged(NamedTuple):
    """Where an attempt at a batch writes."""

    path: str
    run_id: int
    batch_id: int
    attempt: str

    def table(self, name: str) -> str:
        return f"{self.path}/{name}/run_id={self.run_id}/batch_id={self.batch_id}/attempt={self.attempt}"


Stage = Callable[[DataFrame, Staged], None]


def committed(path: str, stage: Stage) -> Callable[[DataStreamWriter], DataStreamWriter]:
    """A sink that has `stage` write the tables of each batch, and commits them when it is done."""
    path = path.rstrip("/")
    known: dict[str, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        if query not in known:
            known[query] = _run_of(spark, path, query)
        staged = Staged(path, known[query], batch_id, uuid.uuid4().hex)
        with adaptive(spark):
            stage(batch, staged)
            commit = spark.sql(f"SELECT '{staged.attempt}' AS attempt")
            commit.write.mode("overwrite").json(f"{path}/commits/run_id={staged.run_id}/batch_id={batch_id}")

    return lambda writer: writer.foreachBatch(write)


def _run_of(spark: SparkSession, path: str, query: str) -> int:
    """The number of the run that a query belongs to; there is one row for each checkpoint that ever wrote here."""
    spark.createDataFrame([], RUNS).write.mode("ignore").json(f"{path}/runs")
    runs = {row["query_id"]: row["run_id"] for row in spark.read.schema(RUNS).json(f"{path}/runs").collect()}
    if query not in runs:
        runs[query] = max(runs.values(), default=0) + 1
        spark.sql(f"SELECT {runs[query]}L AS run_id, '{query}' AS query_id").write.mode("append").json(f"{path}/runs")
    return runs[query]


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Let Spark choose the number of tasks of what a batch writes; a stream's own session does not.

    The micro-batch itself has been planned before its rows are handed over.
    """
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


def read_committed(spark: SparkSession, path: str, table: str, schema: str, last_run: bool = False) -> DataFrame:
    """The rows of a table's committed batches, with `run_id` and `batch_id`; those of the last run only, if asked for.

    Spark compares the files' folders with the commits, and reads no file of an attempt that is not committed.
    """
    # The comparison tells Spark that the commits leave something out, for which it prunes folders at run time.
    commits = spark.read.schema(COMMITS).json(f"{path}/commits").where("attempt > ''")
    if last_run:
        commits = commits.join(commits.agg(F.max("run_id").alias("run_id")), "run_id")
    rows = spark.read.schema(f"{schema}, {COMMITS}").parquet(f"{path}/{table}")
    return rows.join(commits, ["run_id", "batch_id", "attempt"]).select(*(c for c in rows.columns if c != "attempt"))
