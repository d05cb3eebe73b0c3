"""Registered queries: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.errors import StreamingQueryException

from lumetry.functions import (
    ANY_COST,
    COST,
    METER_MEASURES,
    as_variants,
    device_costs,
    device_readings,
    elements,
    event_time,
    lamp_readings,
    meter_readings,
    nonempty,
    parse,
    parse_array,
    payload_text,
    timed,
    to_document,
    variant_elements,
    variant_readings,
    with_cost_default,
    with_parse_status,
)
from lumetry.operators import (
    cost_grains,
    cost_summary,
    drop_resent,
    drop_resent_at_once,
    grown,
    lamp_cities,
    latest_revision,
    meter_summary,
    out_of_band_rate,
    rollup_of_means,
    rollup_of_totals,
    with_city,
    with_derived_current,
    with_out_of_band,
)
from lumetry.operators.summaries import BY_CITY, BY_DEVICE, BY_METER, meter_report, window_text, windowed_sums
from lumetry.functions.variants import variant_fields
from lumetry.plans import LANDED, PIPELINES, cost_cascade, landed_costs
from lumetry.schemas import (
    CITIES,
    CITY_SUMMARY,
    COST_SUMMARY,
    DEVICE_COST,
    DEVICE_FLOAT,
    DEVICE_INT,
    LAMP_BAND,
    LAMP_CITIES,
    METER,
    METER_SUMMARY,
)
from lumetry.session import prepare, shared_folder
from lumetry.sinks import (
    Staged,
    closing_sums,
    committed,
    compact,
    create_if_missing,
    documents,
    folded,
    looked_up,
    merge_bucketed,
    nowhere,
    parquet,
    read_closing_sums,
    read_committed,
    read_delta_grains,
    read_readings,
    read_revisions,
    revisions,
    stage_grains,
    stage_revisions,
)
from lumetry.sources import empty_table, landed_messages, read_json, table_of
from lumetry.streaming import Flow, cost_state, run_available

from . import payloads as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DEVICE_KEYS = ("timestamp", *BY_DEVICE)


def registered(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        context = spark.sparkContext
        if context.master.startswith("local") and not context.getConf().contains("spark.sql.shuffle.partitions"):
            # One machine, nothing chosen: 200 state stores for each aggregate would take longer than the check.
            spark.conf.set("spark.sql.shuffle.partitions", str(context.defaultParallelism))
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


# Float fields are shown as the double of their text, times as wall-clock times.


def shown(rows: DataFrame) -> DataFrame:
    return rows.select(*(_shown(rows, c) for c in rows.columns))


def _shown(rows: DataFrame, name: str) -> Column:
    kind = rows.schema[name].dataType.simpleString()
    column = F.col(f"`{name}`")
    if kind == "float":
        column = column.cast("string").cast("double")
    elif kind == "timestamp":
        column = column.cast("timestamp_ntz")
    return column.alias(name)


def appended(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """Run an append-mode stream over what its source holds and read the table it wrote."""
    folder = shared_folder(spark)
    create_if_missing(spark, f"{folder}/table", _ddl(frame))
    run_available({Flow("rows", frame): parquet(f"{folder}/table")}, f"{folder}/checkpoint")
    return spark.read.schema(frame.schema).parquet(f"{folder}/table")


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)


def revised(spark: SparkSession, flow: Flow, schema: str) -> DataFrame:
    """Run an update-mode stream over what its source holds and read its revisions."""
    folder = shared_folder(spark)
    run_available({flow: revisions(f"{folder}/table")}, f"{folder}/checkpoint")
    return read_revisions(spark, f"{folder}/table", schema)


# Sources


@registered
def src_message_stream(spark, sf_dir):
    landing = shared_folder(spark)
    P.device(P.events(spark, sf_dir)).write.text(landing)
    return shown(appended(spark, device_readings(landed_messages(spark, landing, maxFilesPerTrigger="1"))))


@registered
def src_message_stream_earliest(spark, sf_dir):
    landing = shared_folder(spark)
    P.meter(P.events(spark, sf_dir)).write.text(landing)
    return shown(appended(spark, meter_readings(landed_messages(spark, landing))))


@registered
def src_json_batch(spark, sf_dir):
    landing = shared_folder(spark)
    P.meter(P.events(spark, sf_dir)).write.text(landing)
    return shown(read_json(spark, landing, METER))


@registered
def src_json_stream(spark, sf_dir):
    landing = shared_folder(spark)
    P.meter(P.events(spark, sf_dir)).write.text(landing)
    return shown(appended(spark, timed(read_json(spark, landing, METER, stream=True), "date_time")))


@registered
def src_json_summary(spark, sf_dir):
    landing = shared_folder(spark)
    P.device(P.events(spark, sf_dir)).write.text(landing)
    return shown(cost_summary(timed(read_json(spark, landing, DEVICE_FLOAT), "STIME"), "1 hour"))


@registered
def src_variant_landing(spark, sf_dir):
    """Messages landed as VARIANT by a stream, and their fields read from that."""
    landed = appended(spark, as_variants(P.device(P.event_stream(spark, sf_dir), half_watts=True)))
    return shown(landed.select(*variant_fields(DEVICE_FLOAT)))


@registered
def src_empty_schema(spark, sf_dir):
    return shown(grown(empty_table(spark, DEVICE_INT), parse(P.device(P.events(spark, sf_dir)), DEVICE_INT)))


# Projections


@registered
def prj_payload_text(spark, sf_dir):
    return payload_text(P.events(spark, sf_dir).select(F.col("props").cast("binary").alias("value")))


@registered
def prj_parse_meter(spark, sf_dir):
    return shown(parse(P.meter(P.events(spark, sf_dir)), METER))


@registered
def prj_parse_device_int(spark, sf_dir):
    return shown(parse(P.device(P.events(spark, sf_dir)), DEVICE_INT))


@registered
def prj_parse_device_float(spark, sf_dir):
    return shown(parse(P.device(P.events(spark, sf_dir), half_watts=True), DEVICE_FLOAT))


@registered
def prj_device_cost_columns(spark, sf_dir):
    return shown(device_costs(P.device(P.events(spark, sf_dir))))


@registered
def prj_meter_columns(spark, sf_dir):
    readings = meter_readings(P.meter(P.events(spark, sf_dir)))
    return shown(readings.select("date_time", "id", "city", "`P (watt)`", "`V (volt)`", "`I (amphere)`"))


@registered
def prj_event_time_meter(spark, sf_dir):
    return shown(meter_readings(P.meter(P.events(spark, sf_dir))).select("id", "date_time"))


@registered
def prj_event_time_device(spark, sf_dir):
    messages = P.device_with_bad_messages(P.events(spark, sf_dir))
    return shown(device_readings(messages).select("ID", "STIME"))


@registered
def prj_cost_default(spark, sf_dir):
    messages = P.device_without_some_costs(P.events(spark, sf_dir))
    return shown(with_cost_default(parse(messages, DEVICE_INT)).select("ID", "DID", "COST"))


@registered
def prj_window_text(spark, sf_dir):
    readings = meter_readings(P.meter(P.events(spark, sf_dir)))
    windows = readings.select("id", "date_time", F.window("date_time", "1 minute").alias("w"))
    return shown(windows.select("id", "date_time", window_text().alias("timestamp")))


@registered
def prj_round2(spark, sf_dir):
    sums = device_costs(P.device(P.events(spark, sf_dir))).groupBy("DID").agg(*COST.partials())
    return sums.select("DID", COST.total(2).alias("total_cost"), COST.mean(2).alias("avg_cost"))


@registered
def prj_row_to_document(spark, sf_dir):
    stored = to_document(parse(P.device(P.events(spark, sf_dir)), DEVICE_INT))
    return shown(parse(stored.withColumnRenamed("document", "value"), DEVICE_INT))


# Filters


@registered
def flt_nonempty_payload(spark, sf_dir):
    messages = nonempty(payload_text(P.device_with_bad_messages(P.events(spark, sf_dir))))
    return shown(parse(messages, DEVICE_INT).select("ID", "KPWR", "COST"))


@registered
def flt_event_time_present(spark, sf_dir):
    readings = device_readings(P.device_with_bad_messages(P.events(spark, sf_dir)))
    return shown(readings.where(F.col("STIME").isNotNull()).select("ID", "STIME"))


# Aggregates


@registered
def agg_meter_1m(spark, sf_dir):
    return meter_summary(meter_readings(P.meter(P.events(spark, sf_dir))), "1 minute")


@registered
def agg_meter_5m_rollup(spark, sf_dir):
    return rollup_of_means(meter_readings(P.meter(P.events(spark, sf_dir))))


@registered
def agg_meter_5m_weighted(spark, sf_dir):
    readings = meter_readings(P.meter(P.events(spark, sf_dir)))
    minutes = windowed_sums(readings, "date_time", "1 minute", BY_METER, METER_MEASURES)
    return meter_report(rollup_of_totals(minutes, "5 minutes", BY_METER, METER_MEASURES), BY_METER)


@registered
def agg_city_1m(spark, sf_dir):
    return meter_summary(meter_readings(P.meter(P.events(spark, sf_dir))), "1 minute", BY_CITY)


@registered
def agg_city_5m(spark, sf_dir):
    return meter_summary(meter_readings(P.meter(P.events(spark, sf_dir))), "5 minutes", BY_CITY)


def _cost(spark: SparkSession, sf_dir: str, grain: str, cost: str = "value", **options) -> DataFrame:
    return shown(cost_summary(device_costs(P.device(P.events(spark, sf_dir), cost)), grain, **options))


@registered
def agg_cost_1m(spark, sf_dir):
    return _cost(spark, sf_dir, "1 minute")


@registered
def agg_cost_1h(spark, sf_dir):
    return _cost(spark, sf_dir, "1 hour")


@registered
def agg_cost_1d(spark, sf_dir):
    return _cost(spark, sf_dir, "1 day")


@registered
def agg_cost_1m_rounded(spark, sf_dir):
    """Costs of three decimals, so that there is something to round, and ties."""
    return _cost(spark, sf_dir, "1 minute", "(event_id % 2000) / 1000D", digits=2)


@registered
def agg_cost_fine(spark, sf_dir):
    """Costs of seven decimals, the least of them a ten-millionth."""
    return _cost(spark, sf_dir, "1 hour", "(event_id % 1000 + 1) / 10000000D")


@registered
def agg_cost_any_float(spark, sf_dir):
    """Three readings per event: 2^k, its negative, and some 2^-100. The large ones cancel, whatever the order."""
    rows = P.spread(P.events(spark, sf_dir)).withColumn("k", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    cost = "CASE k WHEN 0 THEN power(2D, event_id % 100) WHEN 1 THEN -power(2D, event_id % 100) ELSE (event_id % 7 + 1) * power(2D, -100) END"
    sums = windowed_sums(device_costs(P.device(rows, cost)), "STIME", "1 hour", BY_DEVICE, [ANY_COST])
    return shown(sums.select(F.col("w.start").alias("timestamp"), *BY_DEVICE, ANY_COST.total().alias("total_cost")))


@registered
def agg_cost_grains(spark, sf_dir):
    return shown(cost_grains(device_costs(P.device(P.events(spark, sf_dir)))))


# Streams


@registered
def str_window_offset(spark, sf_dir):
    """Days that begin at 17:00 UTC, which is midnight at UTC+7."""
    return _cost(spark, sf_dir, "1 day", offset="17 hours")


@registered
def str_cost_1h_update(spark, sf_dir):
    readings = device_costs(P.device(P.event_stream(spark, sf_dir)))
    flow = Flow("cost_1h", cost_summary(readings, "1 hour", "1 hour"), "update")
    return shown(latest_revision(revised(spark, flow, COST_SUMMARY), DEVICE_KEYS).drop("batch_id", "run_id"))


@registered
def str_meter_1m_update(spark, sf_dir):
    (flow,) = PIPELINES["meter_1m"](P.meter(P.event_stream(spark, sf_dir)))
    keys = ("timestamp", *BY_METER)
    return latest_revision(revised(spark, flow, METER_SUMMARY), keys).drop("batch_id", "run_id")


@registered
def str_raw_append(spark, sf_dir):
    return shown(appended(spark, parse(P.meter(P.event_stream(spark, sf_dir)), METER)))


@registered
def str_cost_1h_append(spark, sf_dir):
    readings = device_costs(P.device(P.event_stream(spark, sf_dir)))
    return shown(appended(spark, cost_summary(readings, "1 hour", "1 hour")))


@registered
def str_meter_5m_chained(spark, sf_dir):
    (flow,) = PIPELINES["meter_5m"](P.meter(P.event_stream(spark, sf_dir)))
    return appended(spark, flow.frame)


@registered
def str_late_rows(spark, sf_dir):
    """Messages land in three deliveries, ten days each, with some of the first two held back to the third.

    The stream is restarted for each delivery. What comes more than an hour behind the newest reading of the earlier
    ones finds its window closed.
    """
    folder = shared_folder(spark)
    rows = _with_delivery(P.events(spark, sf_dir))
    summary = cost_summary(device_costs(landed_messages(spark, _landing(spark, folder))), "1 hour", "1 hour")
    for delivery in range(3):
        P.device(rows.where(F.col("delivery") == delivery)).write.mode("append").text(f"{folder}/landing")
        flow = {Flow("cost_1h", summary, "update"): revisions(f"{folder}/table")}
        run_available(flow, f"{folder}/checkpoint")
    table = read_revisions(spark, f"{folder}/table", COST_SUMMARY)
    return shown(latest_revision(table, DEVICE_KEYS).drop("batch_id", "run_id"))


def _with_delivery(rows: DataFrame) -> DataFrame:
    number = """case when day(ts) <= 10 and event_id % 10 = 0 then 2 when day(ts) <= 10 then 0
                     when day(ts) <= 20 and event_id % 10 = 5 then 2 when day(ts) <= 20 then 1 else 2 end"""
    return rows.withColumn("delivery", F.expr(number))


def _landing(spark: SparkSession, folder: str) -> str:
    create_if_missing(spark, f"{folder}/landing", "value STRING", "text")
    return f"{folder}/landing"


@registered
def str_fan_out(spark, sf_dir):
    """Raw readings and three cost grains as four queries side by side; one row per table."""
    folder = shared_folder(spark)
    flows = {
        flow: revisions(f"{folder}/{flow.name}") if flow.mode == "update" else parquet(f"{folder}/{flow.name}")
        for flow in PIPELINES["raw_and_cost"](P.device(P.event_stream(spark, sf_dir)))
    }
    run_available(flows, f"{folder}/checkpoint")
    return _counted(spark, folder, flows)


@registered
def str_fan_out_landed(spark, sf_dir):
    """The same tables with each message parsed once: the grains read what the raw flow landed."""
    folder = shared_folder(spark)
    flows = landed_costs(spark, P.device(P.event_stream(spark, sf_dir)), folder)
    for flow, sink in flows:
        run_available({flow: sink}, f"{folder}/checkpoint")
    return _counted(spark, folder, [flow for flow, _ in flows])


@registered
def str_quarantine(spark, sf_dir):
    """Good and bad messages as two flows; one row per table."""
    folder = shared_folder(spark)
    flows = PIPELINES["checked_device"](P.device_with_bad_messages(P.spread(P.event_stream(spark, sf_dir))))
    run_available({flow: parquet(f"{folder}/{flow.name}") for flow in flows}, f"{folder}/checkpoint")
    good, bad = (spark.read.schema(f.frame.schema).parquet(f"{folder}/{f.name}") for f in flows)
    good = good.groupBy(F.lit("ok").alias("status")).agg(F.count("*").alias("messages"))
    return good.unionByName(bad.groupBy("status").agg(F.count("*").alias("messages")))


def _counted(spark: SparkSession, folder: str, flows: Iterable[Flow]) -> DataFrame:
    counted = []
    for flow in flows:
        if flow.mode == "update":
            table = read_revisions(spark, f"{folder}/{flow.name}", COST_SUMMARY)
            rows, cost = latest_revision(table, DEVICE_KEYS), "total_cost"
        else:
            rows, cost = spark.read.parquet(f"{folder}/{flow.name}"), "COST"
        total = F.sum(F.col(cost).cast("string").cast("decimal(18,2)")).cast("double")
        counted.append(
            rows.agg(F.count("*").alias("rows"), total.alias("total_cost")).withColumn("flow", F.lit(flow.name))
        )
    raw, *grains = counted
    for grain in grains:
        raw = raw.unionByName(grain)
    return raw


@registered
def str_cost_cascade(spark, sf_dir):
    folder = shared_folder(spark)
    tables = cost_cascade(spark, P.device(P.event_stream(spark, sf_dir)), folder, f"{folder}/checkpoint")
    minute, hour, day = (rows.withColumn("grain", F.lit(name)) for name, rows in tables.items())
    return shown(minute.unionByName(hour).unionByName(day))


def _failing_once(stage, batch_id: int):
    """Has one batch lose its executors when its tables are written, but before it is committed."""
    failed = []

    def run(batch: DataFrame, staged: Staged) -> None:
        stage(batch, staged)
        if staged.batch_id == batch_id and not failed:
            failed.append(staged)
            raise RuntimeError("the batch was lost before its commit")

    return run


def _started_again(flow: Flow, sink, checkpoint: str) -> None:
    """Run a query that fails, and start it again from its checkpoint."""
    try:
        run_available({flow: sink}, checkpoint)
    except StreamingQueryException:
        run_available({flow: sink}, checkpoint)
    else:
        raise AssertionError("the first start was to fail")


def _delivered(spark: SparkSession, sf_dir: str, folder: str, payload=P.device) -> str:
    """Messages in three files, ten days each."""
    rows = P.events(spark, sf_dir)
    landing = _landing(spark, folder)
    for first, last in ((1, 10), (11, 20), (21, 31)):
        payload(rows.where(F.expr(f"day(ts) BETWEEN {first} AND {last}"))).coalesce(1).write.mode("append").text(landing)
    return landing


@registered
def str_delta_grains(spark, sf_dir):
    """All grains as sums of deltas, batch by batch; the second batch fails when it is written and is run again."""
    folder = shared_folder(spark)
    messages = landed_messages(spark, _delivered(spark, sf_dir, folder), maxFilesPerTrigger="1")
    sink = committed(f"{folder}/deltas", _failing_once(stage_grains, 1))
    _started_again(Flow("cost_deltas", device_readings(messages)), sink, f"{folder}/checkpoint")
    return shown(read_delta_grains(spark, f"{folder}/deltas"))


@registered
def str_late_side_output(spark, sf_dir):
    """The deliveries of `str_late_rows`: cost per hour of what came in time, and beside it of what found its hour closed."""
    folder = shared_folder(spark)
    rows = _with_delivery(P.events(spark, sf_dir))
    flow = Flow("closing", device_costs(landed_messages(spark, _landing(spark, folder))))
    for delivery in range(3):
        P.device(rows.where(F.col("delivery") == delivery)).write.mode("append").text(f"{folder}/landing")
        run_available({flow: closing_sums(f"{folder}/table", "1 hour", "1 hour")}, f"{folder}/checkpoint")
    on_time = read_closing_sums(spark, f"{folder}/table").withColumn("reason", F.lit("on_time"))
    late = read_readings(spark, f"{folder}/table", "STIME TIMESTAMP, DID INT, DSN STRING, COST FLOAT", "late", "no_time")
    late = late.groupBy(F.window("STIME", "1 hour").alias("w"), *BY_DEVICE, "reason").agg(*COST.partials())
    late = late.select(F.col("w.start").alias("timestamp"), *BY_DEVICE, COST.total().alias("total_cost"), "reason")
    return shown(on_time.unionByName(late))


@registered
def str_landed_city(spark, sf_dir):
    """City summaries of both grains from readings that were parsed once."""
    folder = shared_folder(spark)
    for flow, sink in LANDED["landed_city"](spark, P.meter(P.event_stream(spark, sf_dir)), folder):
        run_available({flow: sink}, f"{folder}/checkpoint")
    both = [
        latest_revision(read_revisions(spark, f"{folder}/city_{grain}", CITY_SUMMARY), ("timestamp", *BY_CITY))
        .drop("batch_id", "run_id")
        .withColumn("grain", F.lit(grain))
        for grain in ("1m", "5m")
    ]
    return both[0].unionByName(both[1])


@registered
def str_landed_checked(spark, sf_dir):
    """Good readings, quarantine and the good ones' cost per hour, from messages that were parsed once; rows and cost."""
    folder = shared_folder(spark)
    for flow, sink in LANDED["landed_checked"](spark, P.device_mixed(P.spread(P.event_stream(spark, sf_dir))), folder):
        run_available({flow: sink}, f"{folder}/checkpoint")
    good = spark.read.parquet(f"{folder}/raw_checked").select(F.lit("raw_checked").alias("flow"), F.col("COST").alias("cost"))
    bad = spark.read.parquet(f"{folder}/raw_quarantine").select("status", F.lit(None).cast("float").alias("cost"))
    hours = latest_revision(read_revisions(spark, f"{folder}/cost_1h", COST_SUMMARY), DEVICE_KEYS)
    hours = hours.select(F.lit("cost_1h"), F.col("total_cost").alias("cost"))
    total = F.sum(F.col("cost").cast("string").cast("decimal(18,2)")).cast("double").alias("total_cost")
    return good.union(bad).union(hours).groupBy("flow").agg(F.count("*").alias("rows"), total)


# Sinks


@registered
def snk_committed_batches(spark, sf_dir):
    """A run of three batches, the second of which is lost before its commit and run again, and a later run of two."""
    folder = shared_folder(spark)
    landing, path = _delivered(spark, sf_dir, folder), f"{folder}/revisions"
    summaries = [
        cost_summary(device_costs(landed_messages(spark, landing, maxFilesPerTrigger=files)), "1 day", "1 day")
        for files in ("1", "2")
    ]
    sink = committed(path, _failing_once(stage_revisions, 1))
    _started_again(Flow("cost_1d", summaries[0], "update"), sink, f"{folder}/first")
    run_available({Flow("cost_1d", summaries[1], "update"): revisions(path)}, f"{folder}/second")
    table = compact(spark, path, f"{folder}/summary", COST_SUMMARY, DEVICE_KEYS)
    return shown(table.drop("batch_id", "run_id"))


@registered
def snk_summary_table(spark, sf_dir):
    folder = shared_folder(spark)
    readings = device_costs(P.device(P.event_stream(spark, sf_dir)))
    flow = Flow("cost_1d", cost_summary(readings, "1 day", "1 day"), "update")
    run_available({flow: revisions(f"{folder}/revisions")}, f"{folder}/checkpoint")
    table = compact(spark, f"{folder}/revisions", f"{folder}/summary", COST_SUMMARY, DEVICE_KEYS)
    return shown(table.drop("batch_id", "run_id"))


@registered
def snk_replayed_batch(spark, sf_dir):
    """All batches written, and written again from a new checkpoint."""
    folder = shared_folder(spark)
    readings = device_costs(P.device(P.event_stream(spark, sf_dir)))
    for attempt in range(2):
        flow = Flow("cost_1d", cost_summary(readings, "1 day", "1 day"), "update")
        run_available({flow: revisions(f"{folder}/revisions")}, f"{folder}/checkpoint_{attempt}")
    table = compact(spark, f"{folder}/revisions", f"{folder}/summary", COST_SUMMARY, DEVICE_KEYS)
    return shown(table.drop("batch_id", "run_id"))


@registered
def snk_raw_documents(spark, sf_dir):
    folder = shared_folder(spark)
    readings = device_readings(P.device(P.event_stream(spark, sf_dir)), DEVICE_INT)
    run_available({Flow("raw_device", readings): documents(f"{folder}/raw")}, f"{folder}/checkpoint")
    return shown(spark.read.schema(readings.schema).json(f"{folder}/raw"))


@registered
def snk_documents_once(spark, sf_dir):
    """Each message twice, as documents whose batch is lost after it was written and is run again; read by `_id`."""
    folder = shared_folder(spark)
    messages = P.device(P.event_stream(spark, sf_dir)).select(F.explode(F.array_repeat("value", 2)).alias("value"))
    readings, failed = device_readings(messages, DEVICE_INT), []

    def lost_once(writer):
        def write(batch, batch_id):
            folded(batch, batch_id).write.mode("append").json(f"{folder}/documents")
            if not failed:
                failed.append(batch_id)
                raise RuntimeError("the batch was lost after its documents were written")

        return writer.foreachBatch(write)

    _started_again(Flow("raw_device", readings), lost_once, f"{folder}/checkpoint")
    schema = f"{_ddl(readings)}, copies BIGINT, _id STRING"
    stored = spark.read.schema(schema).json(f"{folder}/documents").dropDuplicates(["_id"])
    return shown(stored.drop("_id"))


@registered
def snk_bucketed_summary(spark, sf_dir):
    """A bucketed summary of the first two deliveries, into which the revisions of the third are merged."""
    folder = shared_folder(spark)
    landing, name = _landing(spark, folder), f"summary_{folder.rpartition('-')[2]}"
    flow = Flow("cost_1d", cost_summary(device_costs(landed_messages(spark, landing)), "1 day", "40 days"), "update")
    table, seen = None, -1
    for rest in ("event_id % 3 <> 0", "event_id % 3 = 0"):
        P.device(P.events(spark, sf_dir).where(rest)).write.mode("append").text(landing)
        run_available({flow: revisions(f"{folder}/revisions")}, f"{folder}/checkpoint")
        changes = read_revisions(spark, f"{folder}/revisions", COST_SUMMARY).where(F.col("batch_id") > seen)
        table = merge_bucketed(spark, name, f"{folder}/summary", changes, DEVICE_KEYS, 8)
        seen = table.agg(F.max("batch_id")).first()[0]
    return shown(table.drop("batch_id", "run_id"))


@registered
def snk_state_read(spark, sf_dir):
    """The accumulated table of a stream in complete mode, read from its state after two batches."""
    folder = shared_folder(spark)
    messages = landed_messages(spark, _delivered(spark, sf_dir, folder), maxFilesPerTrigger="2")
    flow = Flow("cost_1h", cost_summary(device_costs(messages), "1 hour"), "complete")
    run_available({flow: nowhere()}, f"{folder}/checkpoint")
    return shown(cost_state(spark, f"{folder}/checkpoint", "cost_1h"))


@registered
def snk_parquet_append(spark, sf_dir):
    return shown(appended(spark, meter_readings(P.meter(P.event_stream(spark, sf_dir)))))


# Set operations


@registered
def set_union_all(spark, sf_dir):
    messages = P.device(P.events(spark, sf_dir))
    table = empty_table(spark, DEVICE_INT)
    for _ in range(2):
        table = grown(table, parse(messages, DEVICE_INT))
    return table.groupBy("DID").agg(F.count("*").alias("rows"), F.sum("KPWR").alias("total_kpwr"))


# Checks and look-ups


@registered
def ra_city_lookup(spark, sf_dir):
    cities = table_of(spark, [{"id": str(i), "city": c} for i, c in CITIES.items()], "id STRING, city STRING")
    readings = parse(P.meter(P.events(spark, sf_dir)), METER).drop("city")
    return shown(with_city(readings, cities).select("date_time", "id", "city"))


@registered
def ra_lamp_city(spark, sf_dir):
    rows = [{"city": c, "meters": meters} for c, meters in LAMP_CITIES.items()]
    cities = lamp_cities(table_of(spark, rows, "city STRING, meters ARRAY<INT>"))
    readings = lamp_readings(P.lamp(P.events(spark, sf_dir))).drop("city")
    return shown(with_city(readings, cities, "id_kWh", "id_kWh").select("id_kWh", "timestamp", "city"))


@registered
def ra_out_of_band_lamp_rate(spark, sf_dir):
    readings = lamp_readings(P.lamp(P.events(spark, sf_dir)))
    return shown(out_of_band_rate(readings, "1 hour", BY_CITY, "timestamp", "watt", LAMP_BAND))


@registered
def ra_array_quarantine(spark, sf_dir):
    parsed = with_parse_status(elements(P.device_arrays(P.events(spark, sf_dir))), DEVICE_INT)
    return parsed.groupBy("status").agg(F.count("*").alias("messages"), F.count("ID").alias("with_id"))


@registered
def ra_variant_quarantine(spark, sf_dir):
    sent = variant_elements(as_variants(P.device_mixed(P.events(spark, sf_dir))))
    return variant_readings(sent, DEVICE_INT).groupBy("status").agg(
        F.count("*").alias("messages"), F.count("ID").alias("with_id"), F.count("KPWR").alias("with_power")
    )


@registered
def ra_city_stream(spark, sf_dir):
    """Two deliveries, the second after the table of cities has got its fifth row."""
    folder = shared_folder(spark)
    rows, landing = P.events(spark, sf_dir), _landing(spark, folder)
    readings = meter_readings(landed_messages(spark, landing)).drop("city")
    sink = looked_up(f"{folder}/table", lambda session: session.read.schema("id STRING, city STRING").parquet(f"{folder}/cities"))
    for delivery, ids in enumerate(((1, 2, 3, 4), (5,))):
        cities = table_of(spark, [{"id": str(i), "city": CITIES[i]} for i in ids], "id STRING, city STRING")
        cities.write.mode("append").parquet(f"{folder}/cities")
        P.meter(rows.where(F.col("event_id") % 2 == delivery)).write.mode("append").text(landing)
        run_available({Flow("cities", readings): sink}, f"{folder}/checkpoint")
    schema = f"{_ddl(readings)}, city STRING"
    return shown(read_committed(spark, f"{folder}/table", "readings", schema).select("date_time", "id", "city"))


@registered
def ra_derived_current(spark, sf_dir):
    messages = P.meter(P.events(spark, sf_dir), drift="if(event_id % 7 = 0, 3, 0)")
    return shown(with_derived_current(meter_readings(messages)))


@registered
def ra_out_of_band_rate(spark, sf_dir):
    return shown(out_of_band_rate(meter_readings(P.meter(P.events(spark, sf_dir))), "5 minutes", BY_METER))


@registered
def ra_out_of_band_lamp(spark, sf_dir):
    readings = lamp_readings(P.lamp(P.events(spark, sf_dir)))
    return shown(with_out_of_band(readings, "watt", LAMP_BAND).select("id_kWh", "timestamp", "watt", "out_of_band"))


@registered
def ra_dedup_readings(spark, sf_dir):
    return shown(drop_resent(meter_readings(P.resent(P.meter(P.events(spark, sf_dir))))))


@registered
def ra_dedup_stream(spark, sf_dir):
    readings = meter_readings(P.resent(P.meter(P.event_stream(spark, sf_dir))))
    return shown(appended(spark, drop_resent(readings, delay="1 minute")))


@registered
def ra_dedup_immediate(spark, sf_dir):
    """Three deliveries, each with all that was sent before, every message three times; copies leave nothing behind."""
    folder = shared_folder(spark)
    rows, landing = P.events(spark, sf_dir), _landing(spark, folder)
    readings = drop_resent_at_once(meter_readings(landed_messages(spark, landing)), delay="1 minute")
    for part in (1, 2, 3):
        so_far = rows.where(F.col("event_id") <= rows.agg(F.max("event_id")).first()[0] * part // 3)
        P.resent(P.meter(so_far)).write.mode("append").text(landing)
        run_available({Flow("once", readings): parquet(f"{folder}/table")}, f"{folder}/checkpoint")
    return shown(spark.read.schema(readings.schema).parquet(f"{folder}/table"))


@registered
def ra_latest_revision(spark, sf_dir):
    """Hourly costs as three deliveries would leave them behind: running totals, one revision per delivery."""
    rows = P.events(spark, sf_dir)
    fields = F.from_json(F.expr(f"to_json({P.device_fields()})"), DEVICE_COST)
    readings = rows.select((F.col("event_id") % 3).alias("batch_id"), F.inline(F.array(fields)))
    readings = readings.withColumn("STIME", event_time("STIME"))
    sums = windowed_sums(readings, "STIME", "1 hour", (*BY_DEVICE, "batch_id"), [COST])
    so_far = Window.partitionBy("w", *BY_DEVICE).orderBy("batch_id")
    running = (F.sum("cost_hundredths").over(so_far) / 100).cast("double")
    revised_rows = sums.select(F.col("w.start").alias("timestamp"), *BY_DEVICE, "batch_id", running.alias("total_cost"))
    return shown(latest_revision(revised_rows, DEVICE_KEYS))


@registered
def ra_array_payload(spark, sf_dir):
    return shown(parse_array(P.meter_array(P.events(spark, sf_dir)), METER))


@registered
def ra_quarantine(spark, sf_dir):
    parsed = with_parse_status(P.device_with_bad_messages(P.events(spark, sf_dir)), DEVICE_INT)
    return parsed.groupBy("status").agg(
        F.count("*").alias("messages"), F.count("ID").alias("with_id"), F.count("KPWR").alias("with_power")
    )


@registered
def ra_parse_lamp(spark, sf_dir):
    return shown(lamp_readings(P.lamp(P.events(spark, sf_dir))))
