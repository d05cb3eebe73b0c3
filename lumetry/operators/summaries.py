"""Tumbling-window summaries.

Each is one hash aggregate keyed by window and device or city: Spark adds up within the reading tasks first, so a
device that sends a third of all readings shuffles as a handful of partial sums. Rows without an event time belong
to no window and leave before the shuffle. The same calls work on a stream; `delay` is how long a window stays open
for late readings and has no effect on a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import COST, METER_MEASURES, Measure
from ..schemas import TIME_TEXT

BY_METER = ("id", "city")
BY_CITY = ("city",)
BY_DEVICE = ("DID", "DSN")
COST_GRAINS = {"1m": "1 minute", "1h": "1 hour", "1d": "1 day"}


def windowed_sums(
    readings: DataFrame,
    time: str,
    grain: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    delay: str | None = None,
    offset: str | None = None,
) -> DataFrame:
    """Partial sums per window `w` and key. `offset` moves the window edges, e.g. to a local midnight."""
    timed = readings.where(F.col(time).isNotNull())
    if delay:
        timed = timed.withWatermark(time, delay)
    aggregates = []
    for measure in measures:
        timed, left = measure.prepared(timed)
        aggregates += measure.partials(left)
    return timed.groupBy(F.window(time, grain, startTime=offset).alias("w"), *keys).agg(*aggregates)


def rollup_of_totals(
    sums: DataFrame, grain: str, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Partial sums of a coarser grain from those of a finer one, without another look at the readings."""
    aggregates = [a for m in measures for a in m.merged()]
    return sums.groupBy(F.window(F.window_time("w"), grain).alias("w"), *keys).agg(*aggregates)


def window_text(column: str = "w") -> Column:
    """The start of a window as text."""
    return F.date_format(F.col(f"{column}.start"), TIME_TEXT)


def _meter_columns() -> list[Column]:
    watt, volt, amphere = METER_MEASURES
    return [
        watt.total().alias("total_watt"),
        volt.total().alias("total_volt"),
        amphere.total(2).alias("total_amphere"),
        *(m.mean().alias(f"avg_{m.name}") for m in METER_MEASURES),
    ]


def meter_report(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial sums of meter readings as totals and means."""
    return sums.select(window_text().alias("timestamp"), *keys, *_meter_columns())


def meter_summary(
    readings: DataFrame,
    grain: str,
    keys: Sequence[str] = BY_METER,
    delay: str | None = None,
    offset: str | None = None,
) -> DataFrame:
    """Totals and means of power, voltage and current per window, by meter or by city."""
    sums = windowed_sums(readings, "date_time", grain, keys, METER_MEASURES, delay, offset)
    return meter_report(sums, keys)


def rollup_of_means(
    readings: DataFrame,
    fine: str = "1 minute",
    coarse: str = "5 minutes",
    keys: Sequence[str] = BY_METER,
    delay: str | None = None,
) -> DataFrame:
    """The `coarse` summary of the `fine` summary: sums of its totals, unweighted means of its rounded means.

    A minute with few readings counts as much as one with many; `rollup_of_totals` gives the true mean instead.
    On a stream this needs append mode, so that a minute is added once and not at each of its revisions.
    """
    sums = windowed_sums(readings, "date_time", fine, keys, METER_MEASURES, delay)
    minutes = sums.select("w", *keys, *_meter_columns())
    totals = [
        Measure("total_watt", "total_watt"),
        Measure("total_volt", "total_volt"),
        Measure("total_amphere", "total_amphere", "double"),
    ]
    means = [Measure(f"avg_{m.name}", f"avg_{m.name}", "double") for m in METER_MEASURES]
    aggregates = [a for m in (*totals, *means) for a in m.partials()]
    rolled = minutes.groupBy(F.window(F.window_time("w"), coarse).alias("w"), *keys).agg(*aggregates)
    watt, volt, amphere = totals
    return rolled.select(
        window_text().alias("timestamp"),
        *keys,
        watt.total().alias("total_watt"),
        volt.total().alias("total_volt"),
        amphere.total(2).alias("total_amphere"),
        *(m.mean().alias(m.name) for m in means),
    )


def cost_report(sums: DataFrame, digits: int | None = None) -> DataFrame:
    return sums.select(
        F.col("w.start").alias("timestamp"), *BY_DEVICE, COST.total(digits).alias("total_cost")
    )


def cost_summary(
    readings: DataFrame,
    grain: str,
    delay: str | None = None,
    offset: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Cost per window and device."""
    return cost_report(windowed_sums(readings, "STIME", grain, BY_DEVICE, [COST], delay, offset), digits)


def grain_sums(readings: DataFrame) -> DataFrame:
    """Partial sums of cost per minute, hour and day in one pass; `grain` says which a row belongs to.

    Grouping sets feed each reading to all three grains inside the task that parsed it, so there is one scan and one
    shuffle of partial sums. Write it with `partitionBy("grain")` for a table per grain.
    """
    timed = readings.where(F.col("STIME").isNotNull())
    for grain, length in COST_GRAINS.items():
        timed = timed.withColumn(grain, F.window("STIME", length).start)
    sets = [[grain, *BY_DEVICE] for grain in COST_GRAINS]
    sums = timed.groupingSets(sets, *COST_GRAINS, *BY_DEVICE).agg(*COST.partials())
    names = [F.when(F.col(grain).isNotNull(), grain) for grain in COST_GRAINS]
    return sums.select(F.coalesce(*COST_GRAINS).alias("timestamp"), *BY_DEVICE, *COST.parts, F.coalesce(*names).alias("grain"))


def grain_report(sums: DataFrame) -> DataFrame:
    return sums.select("timestamp", *BY_DEVICE, COST.total().alias("total_cost"), "grain")


def cost_grains(readings: DataFrame) -> DataFrame:
    """Cost per minute, hour and day in one pass."""
    return grain_report(grain_sums(readings))


def added_grains(deltas: DataFrame) -> DataFrame:
    """Cost per grain from partial sums of any number of batches, in any order: they add up."""
    return grain_report(deltas.groupBy("timestamp", *BY_DEVICE, "grain").agg(*COST.merged()))


def grown(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with more rows at its end; duplicates stay."""
    return table.unionByName(rows)
