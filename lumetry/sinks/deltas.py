"""Sinks that add up what each batch brings, without state.

Partial sums of a batch are committed with its readings, and a reader adds up the batches'. No window is open or closed, so
there is no state store, no watermark and no reading that comes too late; a batch that is run again replaces its sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import COST
from ..operators.summaries import BY_DEVICE, added_grains, grain_sums, windowed_sums
from .commits import Staged, committed, read_committed
from .tables import Sink

SUMS = ", ".join(f"{part} {kind}" for part, kind in COST.parts.items())
GRAIN_SUMS = f"timestamp TIMESTAMP, DID INT, DSN STRING, {SUMS}, grain STRING"
WINDOW_SUMS = f"timestamp TIMESTAMP, DID INT, DSN STRING, {SUMS}"
MARKS = "newest TIMESTAMP, closed_before TIMESTAMP, on_time BIGINT, late BIGINT, no_time BIGINT"


def stage_grains(batch: DataFrame, staged: Staged) -> None:
    """Readings, and partial sums of all grains from four columns of what was just written."""
    batch.write.parquet(staged.table("readings"))
    readings = batch.sparkSession.read.schema(batch.schema).parquet(staged.table("readings"))
    sums = grain_sums(readings.select("STIME", *BY_DEVICE, "COST"))
    sums.hint("rebalance", "grain").write.partitionBy("grain").parquet(staged.table("sums"))


def delta_grains(path: str) -> Sink:
    """Land device readings, and their cost per minute, hour and day as partial sums, batch by batch.

    The stream parses a batch once, into Parquet; the sums are made from that, all grains in one pass.
    """
    return committed(path, stage_grains)


def read_delta_grains(spark: SparkSession, path: str, all_runs: bool = False) -> DataFrame:
    """Cost per minute, hour and day as of the last committed batch.

    A new checkpoint that reads all messages again replaces what the earlier ones brought. `all_runs` is for one that goes
    on where the last has ended.
    """
    return added_grains(read_committed(spark, path, "sums", GRAIN_SUMS, last_run=not all_runs))


def closing_sums(path: str, grain: str, delay: str) -> Sink:
    """Cost per window of device readings that come in time, and those that do not, beside it.

    A window closes when a reading of an earlier batch is `delay` newer than its end, as with a watermark. Readings of
    closed windows are kept with the reason `late`, those without a time with `no_time`, all others with `on_time`: every
    reading is in one of the three, and what is on time is in the sums. `marks` says of each batch up to when windows were
    closed, the newest time seen so far, and how many readings went where.
    """

    def stage(batch: DataFrame, staged: Staged) -> None:
        spark = batch.sparkSession
        newest, closed = _closed_before(spark, staged, delay)
        some_time = F.coalesce("STIME", F.timestamp_seconds(F.lit(0)))  # a window of no time would drop the row
        end = F.window(some_time, grain).end
        reason = F.when(F.col("STIME").isNull(), "no_time").when(end <= closed, "late").otherwise("on_time")
        rows = batch.withColumn("reason", reason)
        rows.write.partitionBy("reason").parquet(staged.table("readings"))
        landed = spark.read.schema(rows.schema).parquet(staged.table("readings"))
        on_time = landed.where("reason = 'on_time'").select("STIME", *BY_DEVICE, "COST")
        sums = windowed_sums(on_time, "STIME", grain, BY_DEVICE, [COST])
        sums = sums.select(F.col("w.start").alias("timestamp"), *BY_DEVICE, *COST.parts)
        sums.hint("rebalance").write.parquet(staged.table("sums"))
        counts = [F.count_if(F.col("reason") == name).alias(name) for name in ("on_time", "late", "no_time")]
        marks = landed.agg(F.greatest(F.max("STIME"), newest).alias("newest"), *counts).withColumn("closed_before", closed)
        marks.select("newest", "closed_before", "on_time", "late", "no_time").write.parquet(staged.table("marks"))

    return committed(path, stage)


def _closed_before(spark: SparkSession, staged: Staged, delay: str) -> tuple[Column, Column]:
    """The newest time in earlier batches of this run, and that less the delay; NULL in its first batch."""
    known = (None, None)
    if staged.batch_id:
        marks = read_committed(spark, staged.path, "marks", MARKS)
        marks = marks.where((F.col("run_id") == staged.run_id) & (F.col("batch_id") < staged.batch_id))
        newest = F.max("newest")
        known = marks.agg(F.unix_micros(newest), F.unix_micros(newest - F.expr(f"INTERVAL {delay}"))).first()
    return tuple(F.timestamp_micros(F.lit(micros).cast("bigint")) for micros in known)


def read_closing_sums(spark: SparkSession, path: str) -> DataFrame:
    """Cost per window of the last run."""
    sums = read_committed(spark, path, "sums", WINDOW_SUMS, last_run=True)
    merged = sums.groupBy("timestamp", *BY_DEVICE).agg(*COST.merged())
    return merged.select("timestamp", *BY_DEVICE, COST.total().alias("total_cost"))


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """What each batch of each run found: see closing_sums."""
    return read_committed(spark, path, "marks", MARKS)


def read_readings(spark: SparkSession, path: str, schema: str, *reasons: str) -> DataFrame:
    """The readings of the last run with their reason, those with one of these reasons if some are given."""
    rows = read_committed(spark, path, "readings", f"{schema}, reason STRING", last_run=True)
    return rows.where(F.col("reason").isin(*reasons)) if reasons else rows
