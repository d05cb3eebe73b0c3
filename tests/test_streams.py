import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks import payloads as P
from lumetry.functions import device_costs, meter_readings
from lumetry.operators import cost_summary, drop_resent, latest_revision, meter_summary, out_of_band_rate, rollup_of_means
from lumetry.operators.summaries import BY_CITY, BY_DEVICE
from lumetry.plans import PIPELINES, cost_cascade
from lumetry.schemas import COST_SUMMARY
from lumetry.session import shared_folder
from lumetry.sinks import console, create_if_missing, memory, parquet, read_revisions, revisions
from lumetry.sources import landed_messages
from lumetry.streaming import Flow, await_any, run_available, start

FOLDER = "/root/testdata/sf0.001"
KEYS = ("timestamp", *BY_DEVICE)


class Landing:
    """A folder of messages, delivered one file at a time to a stream that is restarted for each."""

    def __init__(self, spark):
        self.spark, self.folder = spark, shared_folder(spark)
        create_if_missing(spark, f"{self.folder}/landing", "value STRING", "text")
        self.messages = landed_messages(spark, f"{self.folder}/landing")

    def deliver(self, *texts):
        rows = self.spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1)
        rows.write.mode("append").text(f"{self.folder}/landing")

    def run(self, frame, sink, mode="append"):
        run_available({Flow("flow", frame, mode): sink}, f"{self.folder}/checkpoint")


def cost(time, amount):
    return f'{{"STIME":"2024-01-01 {time}","DID":1,"DSN":"a","COST":{amount}}}'


def meter(time, watt):
    return (
        f'{{"date_time":"2024-01-01 {time}","id":"1","city":"Malang","P (watt)":{watt},"V (volt)":100,'
        f'"I (amphere)":{watt / 100}}}'
    )


@pytest.fixture
def landing(spark):
    return Landing(spark)


def test_late_rows_find_their_window_closed(spark, landing):
    frame = cost_summary(device_costs(landing.messages), "1 minute", "1 minute")
    table = f"{landing.folder}/table"
    for time, amount in (("00:00:01", 1), ("00:10:00", 2), ("00:00:02", 4), ("00:09:30", 8)):
        landing.deliver(cost(time, amount))
        landing.run(frame, revisions(table), "update")
    totals = latest_revision(read_revisions(spark, table, COST_SUMMARY), KEYS)
    assert {r["timestamp"].strftime("%H:%M"): r["total_cost"] for r in totals.collect()} == {
        "00:00": 1.0,
        "00:09": 8.0,
        "00:10": 2.0,
    }


def test_late_rows_within_one_run_follow_the_watermark_of_the_batch_before(spark, landing):
    for time, amount in (("00:00:01", 1), ("00:10:00", 2), ("00:00:02", 4), ("00:00:03", 8)):
        landing.deliver(cost(time, amount))
    one_by_one = landed_messages(spark, f"{landing.folder}/landing", maxFilesPerTrigger="1")
    frame = cost_summary(device_costs(one_by_one), "1 minute", "1 minute")
    table = f"{landing.folder}/table"
    landing.run(frame, revisions(table), "update")
    totals = latest_revision(read_revisions(spark, table, COST_SUMMARY), KEYS)
    assert {r["timestamp"].minute: r["total_cost"] for r in totals.collect()} == {0: 5.0, 10: 2.0}


def test_update_mode_keeps_each_revision_and_the_latest_is_the_batch_result(spark, landing):
    frame = cost_summary(device_costs(landing.messages), "1 minute", "1 hour")
    table = f"{landing.folder}/table"
    sent = [("00:00:01", 1), ("00:00:02", 2), ("00:10:00", 4), ("00:00:03", 8)]
    for time, amount in sent:
        landing.deliver(cost(time, amount))
        landing.run(frame, revisions(table), "update")
    stored = read_revisions(spark, table, COST_SUMMARY)
    first = stored.where(F.minute("timestamp") == 0).orderBy("batch_id")
    assert [r["total_cost"] for r in first.collect()] == [1.0, 3.0, 11.0]
    batch = cost_summary(device_costs(landed_messages(spark, f"{landing.folder}/landing", stream=False)), "1 minute")
    assert sorted(latest_revision(stored, KEYS).drop("batch_id", "run_id").collect()) == sorted(batch.collect())


def test_chained_windows_add_each_minute_once(spark, landing):
    frame = rollup_of_means(meter_readings(landing.messages), delay="1 minute")
    table = f"{landing.folder}/table"
    for time, watt in (("00:00:01", 100), ("00:00:02", 200), ("00:03:00", 400), ("00:20:00", 1)):
        landing.deliver(meter(time, watt))
        landing.run(frame, parquet(table))
    (row,) = spark.read.parquet(table).collect()
    assert (row["timestamp"], row["total_watt"], row["avg_watt"]) == ("2024-01-01 00:00:00", 700, 275.0)


def test_a_restart_neither_repeats_nor_skips_rows(spark, landing):
    frame, table = meter_readings(landing.messages), f"{landing.folder}/table"
    for n in range(3):
        landing.deliver(meter(f"00:00:0{n}", n))
        landing.run(frame, parquet(table))
        landing.run(frame, parquet(table))
    assert sorted(r["P (watt)"] for r in spark.read.parquet(table).collect()) == [0, 1, 2]


def test_a_batch_whose_sink_fails_is_run_again(spark, landing):
    frame, table = meter_readings(landing.messages), f"{landing.folder}/table"
    landing.deliver(meter("00:00:01", 1))

    def broken(writer):
        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{table}/revisions/run_id=1/batch_id={batch_id}/attempt=x/day=2024-01-01")
            raise RuntimeError("connection lost")

        return writer.foreachBatch(write)

    with pytest.raises(StreamingQueryException, match="connection lost"):
        landing.run(frame, broken)
    landing.run(frame, revisions(table))
    assert spark.read.parquet(f"{table}/revisions").count() == 2
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    assert read_revisions(spark, table, schema).count() == 1


def test_copies_across_batches_are_dropped(spark, landing):
    frame, table = drop_resent(meter_readings(landing.messages), delay="1 minute"), f"{landing.folder}/table"
    first, second, last = meter("00:00:01", 1), meter("00:00:30", 2), meter("00:10:00", 3)
    for texts in ((first, first), (first, second), (last,)):
        landing.deliver(*texts)
        landing.run(frame, parquet(table))
    assert sorted(r["P (watt)"] for r in spark.read.parquet(table).collect()) == [1, 2]


def test_dropping_copies_from_a_stream_needs_a_delay(landing):
    with pytest.raises(ValueError, match="delay"):
        drop_resent(meter_readings(landing.messages))


def test_copies_can_be_dropped_before_a_summary(spark, landing):
    once = drop_resent(meter_readings(landing.messages), delay="1 minute")
    frame, table = meter_summary(once, "1 minute"), f"{landing.folder}/table"
    landing.deliver(meter("00:00:01", 1), meter("00:00:01", 1), meter("00:00:02", 5), meter("00:30:00", 1))
    landing.run(frame, parquet(table))
    assert [r["total_watt"] for r in spark.read.parquet(table).collect()] == [6]


def test_out_of_band_rate_on_a_stream(spark, landing):
    frame = out_of_band_rate(meter_readings(landing.messages), "1 minute", BY_CITY, delay="1 minute")
    landing.deliver(meter("00:00:01", 250), meter("00:00:02", 301), meter("00:30:00", 1))
    table = f"{landing.folder}/table"
    landing.run(frame, parquet(table))
    (row,) = spark.read.parquet(table).collect()
    assert (row["readings"], row["out_of_band"], row["rate"]) == (2, 1, 0.5)


def test_pipelines_run_on_the_right_messages(spark):
    sent = {
        "meter": P.meter(P.event_stream(spark, FOLDER)),
        "device": P.device_with_bad_messages(P.event_stream(spark, FOLDER)),
        "lamp": P.lamp(P.event_stream(spark, FOLDER)),
    }
    for name, pipeline in PIPELINES.items():
        kind = name if name == "lamp" else "meter" if name in ("raw_meter", "meter_1m", "meter_5m", "city") else "device"
        folder = shared_folder(spark)
        flows = pipeline(sent[kind])
        sinks = {
            f: revisions(f"{folder}/{f.name}", files=1) if f.mode == "update" else parquet(f"{folder}/{f.name}")
            for f in flows
        }
        run_available(sinks, f"{folder}/checkpoint")
        for flow in flows:
            table = f"{folder}/{flow.name}/revisions" if flow.mode == "update" else f"{folder}/{flow.name}"
            assert spark.read.parquet(table).count() > 0, flow.name


def test_cascade_continues_where_it_stopped(spark, landing):
    folder = f"{landing.folder}/cascade"

    def totals():
        tables = cost_cascade(spark, landing.messages, folder, f"{landing.folder}/checkpoint")
        return {name: [r["total_cost"] for r in t.orderBy("timestamp").collect()] for name, t in tables.items()}

    landing.deliver(cost("00:00:01", 0.1), cost("00:00:02", 0.2), cost("00:01:00", 4), cost("01:30:00", 8))
    assert totals() == {"1m": [], "1h": [], "1d": []}
    landing.deliver(cost("00:01:30", 16), cost("05:00:00", 32).replace("01-01", "01-03"))
    assert totals() == {"1m": [0.3, 20.0, 8.0], "1h": [20.3], "1d": []}
    landing.deliver(cost("07:00:00", 1).replace("01-01", "01-05"))
    assert totals()["1h"] == [20.3, 8.0]


def test_memory_and_console_sinks(spark, landing):
    landing.deliver(meter("00:00:01", 77))
    frame = meter_readings(landing.messages)
    query = start(Flow("watts", frame), memory("watts"), landing.folder, available_now=True)
    query.awaitTermination()
    assert [r["P (watt)"] for r in spark.table("watts").collect()] == [77]
    query = start(Flow("shown", frame), console(), landing.folder, available_now=True)
    query.awaitTermination()
    assert "ConsoleTable" in query.lastProgress["sink"]["description"]
    assert query.lastProgress["numInputRows"] == 1


def test_waiting_ends_with_the_first_failure_and_stops_the_others(spark, landing):
    landing.deliver(meter("00:00:01", 1))
    frame = meter_readings(landing.messages)

    def failing(writer):
        def write(batch, batch_id):
            raise RuntimeError("no disk")

        return writer.foreachBatch(write)

    ended = start(Flow("ended", frame), parquet(f"{landing.folder}/ended"), landing.folder, available_now=True)
    ended.awaitTermination()  # a query that ended before is no reason to stop these
    queries = [
        start(Flow("steady", frame, every="1 second"), parquet(f"{landing.folder}/table"), landing.folder),
        start(Flow("failing", frame, every="1 second"), failing, landing.folder),
    ]
    with pytest.raises(StreamingQueryException, match="no disk"):
        await_any(queries)
    assert not any(q.isActive for q in queries)
