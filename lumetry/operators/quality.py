"""Checks on readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact
from ..schemas import METER_BAND


def with_derived_current(readings: DataFrame) -> DataFrame:
    """Current from power over voltage, and whether the reported one is within half a hundredth of it.

    Both are NULL where a figure is missing or the voltage is zero.
    """
    watt, volt = "cast(`P (watt)` AS decimal(10,0))", "cast(`V (volt)` AS decimal(10,0))"
    off = f"abs({exact('`I (amphere)`', 'float')} * {volt} - {watt})"
    return readings.withColumns(
        {
            "derived_amphere": F.expr(f"double(round(try_divide({watt}, {volt}), 2))"),
            "consistent": F.expr(f"CASE WHEN {volt} <> 0 THEN {off} <= abs({volt}) * 0.005BD END"),
        }
    )


def with_out_of_band(
    readings: DataFrame, column: str = "P (watt)", band: tuple[int, int] = METER_BAND
) -> DataFrame:
    """Flag readings outside the usual range, whose edges belong to it."""
    return readings.withColumn("out_of_band", ~F.col(f"`{column}`").between(*band))


def out_of_band_rate(
    readings: DataFrame,
    grain: str,
    keys: Sequence[str],
    time: str = "date_time",
    column: str = "P (watt)",
    band: tuple[int, int] = METER_BAND,
    delay: str | None = None,
) -> DataFrame:
    """Per window and key: readings with the figure, those out of band, and their share."""
    flagged = with_out_of_band(readings.where(F.col(time).isNotNull()), column, band)
    if delay:
        flagged = flagged.withWatermark(time, delay)
    counted = flagged.groupBy(F.window(time, grain).alias("w"), *keys).agg(
        F.count("out_of_band").alias("readings"),
        F.count_if("out_of_band").alias("out_of_band"),
    )
    return counted.select(
        F.col("w.start").alias("timestamp"),
        *keys,
        "readings",
        "out_of_band",
        F.try_divide("out_of_band", "readings").alias("rate"),
    )


def drop_resent(readings: DataFrame, time: str = "date_time", delay: str | None = None) -> DataFrame:
    """Each reading once, however often it was sent. Copies agree in every field, event time included.

    Grouping by all fields lets every task fold its own copies before the shuffle, so a reading that makes up a
    third of the input is no hot spot. A stream keeps a reading in state until its time is `delay` behind and
    hands it on then; readings without a time cannot expire and are left out of the streaming form only.
    """
    columns = readings.columns
    if not readings.isStreaming:
        return readings.distinct()
    if not delay:
        raise ValueError("a stream needs a delay, or its state grows for ever")
    timed = readings.where(F.col(time).isNotNull()).withWatermark(time, delay)
    quoted = [f"`{c}`" for c in columns]
    once = timed.groupBy(*quoted).agg(F.count(F.lit(1)).alias("_copies"))
    return once.select(*quoted)


def drop_resent_at_once(readings: DataFrame, time: str = "date_time", delay: str = "1 day") -> DataFrame:
    """Each reading of a stream once, handed on in the batch that first brings it. Copies agree in every field.

    The state holds 128 bits for each reading, until its time is `delay` behind the newest; a copy that comes later than
    that is left out as too late, and so is a reading that does. Readings without a time could never be forgotten and are
    left out, too. `drop_resent` waits for the delay instead, and folds copies before the shuffle.
    """
    columns = [F.col(f"`{c}`") for c in readings.columns]
    fields = [field for c in columns for field in (c, c.isNull())]  # a hash passes over NULLs
    digests = {f"_digest_{k}": F.xxhash64(F.lit(k), *fields) for k in (0, 1)}
    timed = readings.where(F.col(time).isNotNull()).withWatermark(time, delay).withColumns(digests)
    return timed.dropDuplicatesWithinWatermark(list(digests)).drop(*digests)
