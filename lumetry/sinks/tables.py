"""Stream sinks. Each call returns a function that sets up a `DataStreamWriter`.

Executors write in parallel and a batch that fails fails the query, so Spark runs it again from the checkpoint. A
sink must not show the second run as more rows: file sinks keep a log of finished batches, `revisions` commits each
batch when all of it is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..operators.revisions import latest_revision
from .commits import Staged, committed, read_committed

Sink = Callable[[DataStreamWriter], DataStreamWriter]


def console(truncate: bool = False) -> Sink:
    return lambda writer: writer.format("console").option("truncate", truncate)


def memory(name: str) -> Sink:
    """A table on the driver, for a look at a small stream."""
    return lambda writer: writer.format("memory").queryName(name)


def nowhere() -> Sink:
    """For a stream whose state is read: see `cost_state`."""
    return lambda writer: writer.format("noop")


def parquet(path: str, partition_by: Sequence[str] = ()) -> Sink:
    """Append rows to a Parquet table."""
    return _files("parquet", path, partition_by)


def documents(path: str, partition_by: Sequence[str] = ()) -> Sink:
    """Append each row as one JSON document."""
    return _files("json", path, partition_by)


def _files(kind: str, path: str, partition_by: Sequence[str]) -> Sink:
    def setup(writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.format(kind).option("path", path)
        return writer.partitionBy(*partition_by) if partition_by else writer

    return setup


def document_store(connector: str, key: Sequence[str] = (), once: bool = False, **options: str) -> Sink:
    """Append rows as documents through a Spark connector, e.g. `mongodb`, which makes the collection if missing.

    With `key`, columns that tell messages apart (such as topic, partition and offset, which `kafka_messages` keeps on
    request), each document gets an `_id` made of them: a batch that is run again replaces its documents in a store that
    writes by `_id`. Where messages have no such columns, `once` makes the `_id` of the document's content and its batch;
    rows of a batch that agree in everything are then one document, and `copies` says how many there were. With neither, a
    batch that is run again adds its documents again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if key:
            batch = batch.withColumn("_id", F.concat_ws("/", *key)).drop(*key)
        elif once:
            batch = folded(batch, batch_id)
        batch.write.format(connector).options(**options).mode("append").save()

    return lambda writer: writer.foreachBatch(write)


def folded(batch: DataFrame, batch_id: int) -> DataFrame:
    """Each different row of a batch once, with an `_id` that a second run of the batch gives it again, and its `copies`.

    Equal rows are folded within each task first, so a reading that makes up a third of the batch is no hot spot.
    """
    fields = [F.col(f"`{c}`") for c in batch.columns]
    counted = batch.groupBy(*fields).agg(F.count(F.lit(1)).alias("copies"))
    content = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    return counted.withColumn("_id", F.concat(F.lit(f"{batch_id}/"), content))


def stage_revisions(batch: DataFrame, staged: Staged, files: int | None = None) -> None:
    rows = _by_day(batch)
    rows = rows.repartition(files) if files else rows.hint("rebalance", "day")
    rows.write.partitionBy("day").parquet(staged.table("revisions"))


def revisions(path: str, files: int | None = None) -> Sink:
    """Keep what each batch changed, in folders per day (that of `timestamp`), and commit it when all of it is written.

    For update mode, which emits a window again whenever it changes. A batch that failed halfway is not seen and one that
    is run again replaces itself; a new checkpoint counts batches from 0 again, as a later run. Batches are written in
    as many tasks as their size asks for, or in `files`.
    """
    return committed(path, lambda batch, staged: stage_revisions(batch, staged, files))


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.to_date("timestamp") if "timestamp" in rows.columns else F.lit(None).cast("date"))


def _replacing(rows: DataFrame) -> DataFrameWriter:
    """A writer that replaces the partitions that it writes and leaves the others."""
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def create_if_missing(spark: SparkSession, path: str, schema: str | StructType, kind: str = "parquet") -> None:
    """An empty table with this schema, unless there is one."""
    spark.createDataFrame([], schema).write.format(kind).mode("ignore").save(path)


def read_revisions(
    spark: SparkSession, path: str, schema: str, days: tuple[str, str] | None = None
) -> DataFrame:
    """All revisions with their `run_id` and `batch_id`, or those of windows from the first to the last of two days."""
    rows = read_committed(spark, path, "revisions", f"{schema}, day DATE")
    return (rows.where(F.col("day").between(*days)) if days else rows).drop("day")


def compact(
    spark: SparkSession, path: str, target: str, schema: str, keys: Sequence[str], days: tuple[str, str] | None = None
) -> DataFrame:
    """Write the latest revision of each key to `target`, a folder per day, and return that table.

    With `days`, such as the one that has just closed, only their revisions are read and only their folders replaced:
    closed days are settled once and then left alone.
    """
    _replacing(_by_day(latest_revision(read_revisions(spark, path, schema, days), keys))).partitionBy("day").parquet(target)
    return spark.read.schema(f"{schema}, run_id BIGINT, batch_id BIGINT, day DATE").parquet(target).drop("day")
