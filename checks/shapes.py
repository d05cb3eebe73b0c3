"""Plan shapes compared at volume: `python -m checks.shapes [messages per event]`.

"plain" is what one writes first: the parsed struct expanded in a projection, float sums, and every grain from the
messages. Each is run three times and the best time counts.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetry.functions import device_costs, event_time, meter_readings, timed
from lumetry.operators import cost_grains, cost_summary, drop_resent, meter_summary, rollup_of_means
from lumetry.plans import PIPELINES, cost_cascade
from lumetry.schemas import DEVICE_FLOAT, DEVICE_INT, METER
from lumetry.session import prepare, shared_folder
from lumetry.sinks import parquet, revisions
from lumetry.sources import landed_messages, read_json
from lumetry.streaming import run_available

from . import payloads as P
from .compare import local_session

FOLDER = "/root/testdata/sf0.1"


def plain(messages: DataFrame, schema: str, time_column: str) -> DataFrame:
    parsed = messages.select(F.from_json("value", schema).alias("data")).select("data.*")
    return parsed.withColumn(time_column, event_time(time_column))


def plain_meter(messages: DataFrame) -> DataFrame:
    columns = {"watt": "`P (watt)`", "volt": "`V (volt)`", "amphere": "`I (amphere)`"}
    window = F.window("date_time", "1 minute").alias("w")
    return plain(messages, METER, "date_time").groupBy(window, "id", "city").agg(
        *(F.round(F.sum(c), 2).alias(f"total_{n}") for n, c in columns.items()),
        *(F.round(F.avg(c), 2).alias(f"avg_{n}") for n, c in columns.items()),
    )


def plain_cost(messages: DataFrame, grain: str) -> DataFrame:
    window = F.window("STIME", grain).alias("w")
    return plain(messages, DEVICE_INT, "STIME").groupBy(window, "DID", "DSN").agg(F.sum("COST").alias("total_cost"))


def plain_grains(messages: DataFrame) -> DataFrame:
    minute, hour, day = (plain_cost(messages, g) for g in ("1 minute", "1 hour", "1 day"))
    return minute.unionByName(hour).unionByName(day)


def run(frame: Callable[[], DataFrame]) -> None:
    frame().write.format("noop").mode("overwrite").save()


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 40
    spark = prepare(local_session())
    folder = shared_folder(spark)
    ids = F.expr(f"transform(sequence(0, {copies - 1}), k -> event_id * {copies} + k)")
    rows = P.events(spark, FOLDER).withColumn("event_id", F.explode(ids))
    P.meter(rows).write.text(f"{folder}/meter")
    P.device(rows).write.text(f"{folder}/device")
    meter, device = (landed_messages(spark, f"{folder}/{kind}", stream=False) for kind in ("meter", "device"))
    total = meter.count()
    stream = landed_messages(spark, f"{folder}/device")

    def fan_out() -> None:
        out = shared_folder(spark)
        run_available({f: revisions(f"{out}/{f.name}") for f in PIPELINES["cost"](stream)}, f"{out}/checkpoint")

    def cascade() -> None:
        out = shared_folder(spark)
        cost_cascade(spark, stream, out, f"{out}/checkpoint")

    def chained() -> None:
        out = shared_folder(spark)
        (flow,) = PIPELINES["meter_5m"](landed_messages(spark, f"{folder}/meter"))
        run_available({flow: parquet(f"{out}/table")}, f"{out}/checkpoint")

    shapes: dict[str, Callable[[], None]] = {
        "meter_1m plain": lambda: run(lambda: plain_meter(meter)),
        "meter_1m": lambda: run(lambda: meter_summary(meter_readings(meter), "1 minute")),
        "meter_1m, files read as JSON": lambda: run(
            lambda: meter_summary(timed(read_json(spark, f"{folder}/meter", METER), "date_time"), "1 minute")
        ),
        "meter_5m rollup": lambda: run(lambda: rollup_of_means(meter_readings(meter))),
        "cost_1h plain": lambda: run(lambda: plain_cost(device, "1 hour")),
        "cost_1h": lambda: run(lambda: cost_summary(device_costs(device), "1 hour")),
        "cost_1h, files read as JSON": lambda: run(
            lambda: cost_summary(timed(read_json(spark, f"{folder}/device", DEVICE_FLOAT), "STIME"), "1 hour")
        ),
        "three grains plain": lambda: run(lambda: plain_grains(device)),
        "three grains": lambda: run(lambda: cost_grains(device_costs(device))),
        "three grains, files read as JSON": lambda: run(
            lambda: cost_grains(timed(read_json(spark, f"{folder}/device", DEVICE_FLOAT), "STIME"))
        ),
        "drop copies": lambda: run(lambda: drop_resent(meter_readings(meter))),
        "stream: three grains, one query each": fan_out,
        "stream: three grains, cascade": cascade,
        "stream: 1m -> 5m chained": chained,
    }
    best: dict[str, float] = {}
    for _ in range(3):
        for name, shape in shapes.items():
            begin = time.perf_counter()
            shape()
            best[name] = min(best.get(name, float("inf")), time.perf_counter() - begin)
    for name, seconds in best.items():
        print(f"{name:40} {seconds:7.2f} s {total / seconds / 1000:9.0f} k messages/s", flush=True)


if __name__ == "__main__":
    main()
