"""The pipelines, from messages to the flows a runner starts.

Three shapes. In PIPELINES each flow reads the messages by itself and has its own checkpoint, so one that fails does not
hold up the others, and every flow parses the messages anew. In LANDED the first flow parses them once and lands them as
Parquet, which the others read. In COMMITTED one flow without state parses a batch once and commits it together with its
partial sums, which readers add up. (`cost_cascade`, where each grain reads the table of the grain below and minutes stay
open for a day, is kept for those who need closed windows only.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import COST
from ..functions.parsing import (
    device_costs,
    device_readings,
    lamp_readings,
    meter_readings,
    parse,
    position,
    timed,
)
from ..functions.variants import as_variants, variant_readings
from ..operators.quality import drop_resent_at_once, out_of_band_rate
from ..operators.summaries import (
    BY_CITY,
    BY_DEVICE,
    COST_GRAINS,
    cost_summary,
    meter_summary,
    rollup_of_means,
    windowed_sums,
)
from ..schemas import DEVICE_FLOAT, LAMP_BAND, METER
from ..sinks.deltas import delta_grains
from ..sinks.tables import Sink, create_if_missing, parquet, revisions
from ..streaming.runner import Flow, run_available


def raw_meter(messages: DataFrame) -> list[Flow]:
    """Parsed meter readings as they come."""
    return [Flow("raw_meter", parse(messages, METER, position(messages)))]


def raw_device(messages: DataFrame) -> list[Flow]:
    """Parsed device readings as they come."""
    return [Flow("raw_device", device_readings(messages, keep=position(messages)))]


def meter_1m(messages: DataFrame) -> list[Flow]:
    """Every minute, the summaries that changed."""
    summary = meter_summary(meter_readings(messages), "1 minute", delay="1 minute")
    return [Flow("meter_1m", summary, "update", "60 seconds")]


def meter_5m(messages: DataFrame) -> list[Flow]:
    """Five-minute summaries of the one-minute summaries, each once its window is closed."""
    return [Flow("meter_5m", rollup_of_means(meter_readings(messages), delay="1 minute"), "append", "300 seconds")]


def city(messages: DataFrame) -> list[Flow]:
    """City summaries per minute and per five minutes, both from the readings."""
    return _city(meter_readings(messages))


def _city(readings: DataFrame) -> list[Flow]:
    return [
        Flow("city_1m", meter_summary(readings, "1 minute", BY_CITY, "1 minute"), "update", "60 seconds"),
        Flow("city_5m", meter_summary(readings, "5 minutes", BY_CITY, "5 minutes"), "update", "300 seconds"),
    ]


def cost_1m_rounded(messages: DataFrame) -> list[Flow]:
    """Device cost per minute to two digits."""
    summary = cost_summary(device_costs(messages), "1 minute", "1 minute", digits=2)
    return [Flow("cost_1m_rounded", summary, "update", "1 minute")]


def cost(messages: DataFrame) -> list[Flow]:
    """Device cost per minute, hour and day. A grain waits one window for late readings."""
    readings = device_costs(messages)
    return [
        Flow("cost_1m", cost_summary(readings, "1 minute", "1 minute"), "update", "1 minute"),
        Flow("cost_1h", cost_summary(readings, "1 hour", "1 hour"), "update", "1 hour"),
        Flow("cost_1d", cost_summary(readings, "1 day", "1 day"), "update", "1 day"),
    ]


def lamp(messages: DataFrame) -> list[Flow]:
    """Lamp readings as they come, and per minute and city the share of those outside the usual power range."""
    readings = lamp_readings(messages)
    return [Flow("raw_lamp", readings), _lamp_band(readings)]


def _lamp_band(readings: DataFrame) -> Flow:
    rate = out_of_band_rate(readings, "1 minute", BY_CITY, "timestamp", "watt", LAMP_BAND, delay="1 minute")
    return Flow("lamp_band_1m", rate, "append", "60 seconds")


def checked_device(messages: DataFrame) -> list[Flow]:
    """Device readings that are as they should be, and all other messages with what is wrong with them.

    Messages may hold arrays. Every element goes to one of the two, and an array without elements to the second.
    """
    checked = variant_readings(as_variants(messages), DEVICE_FLOAT, elements=True)
    good = timed(checked.where("status = 'ok'").drop("value", "status"), "STIME")
    return [Flow("raw_checked", good), Flow("raw_quarantine", checked.where("status <> 'ok'").select("value", "status"))]


def raw_and_cost(messages: DataFrame) -> list[Flow]:
    """Device readings as documents, and their cost per grain."""
    return [*raw_device(messages), *cost(messages)]


PIPELINES: dict[str, Callable[[DataFrame], list[Flow]]] = {
    "raw_meter": raw_meter,
    "raw_device": raw_device,
    "meter_1m": meter_1m,
    "meter_5m": meter_5m,
    "city": city,
    "cost_1m_rounded": cost_1m_rounded,
    "cost": cost,
    "raw_and_cost": raw_and_cost,
    "lamp": lamp,
    "checked_device": checked_device,
}


Flows = list[tuple[Flow, Sink]]


def _landed(spark: SparkSession, flow: Flow, path: str) -> tuple[tuple[Flow, Sink], DataFrame]:
    """A flow that lands typed rows below `path`, and what it lands as a stream."""
    table = f"{path}/{flow.name}"
    create_if_missing(spark, table, flow.frame.schema)
    landed = spark.readStream.schema(flow.frame.schema).option("maxFileAge", "3650d").parquet(table)
    return (flow, parquet(table)), landed


def _onward(flows: list[Flow], path: str) -> Flows:
    return [(flow, (revisions if flow.mode == "update" else parquet)(f"{path}/{flow.name}")) for flow in flows]


def landed_costs(spark: SparkSession, messages: DataFrame, path: str) -> Flows:
    """Device readings and their cost per minute, hour and day, with every message parsed once.

    The raw flow lands typed Parquet below `path`; each grain reads the four columns it needs of that and keeps windows
    open for a time of its own, so state is as small as with separate readers. Start all of them together, or the raw flow
    first over what is there.
    """
    raw, landed = _landed(spark, Flow("raw_device", device_readings(messages)), path)
    columns = landed.select("STIME", *BY_DEVICE, "COST")
    grains = [Flow(f"cost_{name}", cost_summary(columns, grain, grain), "update", grain) for name, grain in COST_GRAINS.items()]
    return [raw, *_onward(grains, path)]


def landed_city(spark: SparkSession, messages: DataFrame, path: str) -> Flows:
    """Meter readings, and city summaries per minute and per five minutes, with every message parsed once."""
    raw, landed = _landed(spark, Flow("raw_meter", meter_readings(messages)), path)
    return [raw, *_onward(_city(landed), path)]


def landed_lamp(spark: SparkSession, messages: DataFrame, path: str) -> Flows:
    """Lamp readings, and the share of those out of band per minute and city, with every message parsed once."""
    raw, landed = _landed(spark, Flow("raw_lamp", lamp_readings(messages)), path)
    return [raw, *_onward([_lamp_band(landed)], path)]


def landed_checked(spark: SparkSession, messages: DataFrame, path: str) -> Flows:
    """Messages as VARIANT, parsed once; from these the device readings that are as they should be, all other messages with
    what is wrong with them, and the cost of the good ones per hour.

    Messages may hold arrays. Every element goes to one of the two, and an array without elements to the second. The
    text is landed where it is no JSON, or else its content only.
    """
    sent = as_variants(messages).withColumn("value", F.when(F.col("content").isNull(), F.col("value")))
    raw, landed = _landed(spark, Flow("raw_messages", sent), path)
    checked = variant_readings(landed, DEVICE_FLOAT, elements=True)
    good = Flow("raw_checked", timed(checked.where("status = 'ok'").drop("value", "status"), "STIME"))
    bad = Flow("raw_quarantine", checked.where("status <> 'ok'").select("value", "status"))
    good_ones, readings = _landed(spark, good, path)
    cost_1h = Flow("cost_1h", cost_summary(readings.select("STIME", *BY_DEVICE, "COST"), "1 hour", "1 hour"), "update", "1 hour")
    return [raw, good_ones, *_onward([bad, cost_1h], path)]


LANDED: dict[str, Callable[[SparkSession, DataFrame, str], Flows]] = {
    "landed_costs": landed_costs,
    "landed_city": landed_city,
    "landed_lamp": landed_lamp,
    "landed_checked": landed_checked,
}


def cost_deltas(messages: DataFrame, path: str, resent: str | None = None) -> Flows:
    """Device readings and their cost per minute, hour and day in one flow, added up batch by batch: no window closes, and
    no reading is late. `resent` is how far apart copies of a reading may be sent, to count each once; that takes state."""
    readings = device_readings(messages)
    if resent:
        readings = drop_resent_at_once(readings, "STIME", resent)
    return [(Flow("cost_deltas", readings), delta_grains(f"{path}/cost_deltas"))]


COMMITTED: dict[str, Callable[[DataFrame, str], Flows]] = {"cost_deltas": cost_deltas}


def cost_cascade(spark: SparkSession, messages: DataFrame, path: str, checkpoint: str) -> dict[str, DataFrame]:
    """Closed cost windows per minute, hour and day, with the messages read and parsed once.

    Minutes are appended to a table of partial sums; hours read that table as a stream, and days the hours'. A
    minute stays open for a day, so whatever the daily grain would still accept is in every grain. Runs over what is
    there now; call it again (same `path` and `checkpoint`) for what came since.
    """
    parts = ", ".join(f"{part} {kind}" for part, kind in COST.parts.items())
    stored = f"timestamp TIMESTAMP, DID INT, DSN STRING, {parts}"
    frame = windowed_sums(device_costs(messages), "STIME", "1 minute", BY_DEVICE, [COST], "1 day")
    tables = {}
    for name, coarser in (("1m", "1 hour"), ("1h", "1 day"), ("1d", None)):
        table = f"{path}/{name}"
        create_if_missing(spark, table, stored)
        closed = frame.select(F.col("w.start").alias("timestamp"), *BY_DEVICE, *COST.parts)
        run_available({Flow(f"cascade_{name}", closed): parquet(table)}, checkpoint)
        tables[name] = spark.read.schema(stored).parquet(table).select(
            "timestamp", *BY_DEVICE, COST.total().alias("total_cost")
        )
        if coarser:
            # Windows arrive in the order in which they closed, so the coarser grain need not wait for late ones.
            finer = spark.readStream.schema(stored).parquet(table).withWatermark("timestamp", "0 seconds")
            frame = finer.groupBy(F.window("timestamp", coarser).alias("w"), *BY_DEVICE).agg(*COST.merged())
    return tables
