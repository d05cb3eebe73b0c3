"""Batches are committed whole or not at all, and later runs win."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks import payloads as P
from lumetry.functions import device_costs, device_readings, meter_readings
from lumetry.operators import cost_grains, cost_summary, drop_resent_at_once, latest_revision
from lumetry.plans import cost_deltas
from lumetry.schemas import COST_SUMMARY
from lumetry.session import shared_folder
from lumetry.sinks import (
    closing_sums,
    committed,
    create_if_missing,
    looked_up,
    parquet,
    read_closing_sums,
    read_committed,
    read_delta_grains,
    read_marks,
    read_readings,
    read_revisions,
    revisions,
    stage_grains,
)
from lumetry.sources import landed_messages
from lumetry.streaming import Flow, progress_log, run_available

FOLDER = "/root/testdata/sf0.001"
READING = "STIME TIMESTAMP, DID INT, DSN STRING, COST FLOAT"


class Writer:
    """Stands in for a DataStreamWriter and keeps the batch function."""

    def foreachBatch(self, write):
        self.write = write
        return self


class Landing:
    """Messages in files, each of which is a batch, or all that are new."""

    def __init__(self, spark):
        self.spark, self.folder = spark, shared_folder(spark)
        create_if_missing(spark, f"{self.folder}/landing", "value STRING", "text")

    def messages(self, **options):
        return landed_messages(self.spark, f"{self.folder}/landing", **options)

    def deliver(self, *texts):
        rows = self.spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1)
        rows.write.mode("append").text(f"{self.folder}/landing")

    def run(self, frame, sink, mode="append", checkpoint="checkpoint"):
        run_available({Flow("flow", frame, mode): sink}, f"{self.folder}/{checkpoint}")


@pytest.fixture
def landing(spark):
    return Landing(spark)


def cost(time, amount, day="01"):
    return f'{{"STIME":"2024-01-{day} {time}","DID":1,"DSN":"a","COST":{amount}}}'


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n INT")


def test_all_tables_of_a_batch_appear_together(spark):
    path, broken = shared_folder(spark), []

    def stage(batch, staged):
        batch.write.parquet(staged.table("plain"))
        if broken:
            raise RuntimeError("lost")
        batch.selectExpr("-n AS n").write.parquet(staged.table("minus"))

    write = committed(path, stage)(Writer()).write

    def found(table):
        return sorted((r["n"], r["run_id"], r["batch_id"]) for r in read_committed(spark, path, table, "n INT").collect())

    write(numbers(spark, 1, 2), 0)
    broken.append(True)
    with pytest.raises(RuntimeError, match="lost"):
        write(numbers(spark, 3), 1)
    assert found("plain") == [(1, 1, 0), (2, 1, 0)] and found("minus") == [(-2, 1, 0), (-1, 1, 0)]
    broken.clear()
    for _ in range(2):  # and once more, as if Spark had not heard of the commit
        write(numbers(spark, 3), 1)
    assert found("plain") == [(1, 1, 0), (2, 1, 0), (3, 1, 1)] and found("minus") == [(-3, 1, 1), (-2, 1, 0), (-1, 1, 0)]


def test_files_of_lost_attempts_are_not_read(spark):
    path = shared_folder(spark)
    write = committed(path, lambda batch, staged: batch.write.parquet(staged.table("t")))(Writer()).write
    for n in range(3):
        write(numbers(spark, n), 0)
    assert spark.read.parquet(f"{path}/t").count() == 3
    rows = read_committed(spark, path, "t", "n INT")
    assert [r["n"] for r in rows.collect()] == [2]
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()


def test_a_checkpoint_is_a_run_and_a_new_one_the_next(spark, landing):
    landing.deliver(cost("00:00:01", 1), cost("05:00:00", 2))
    frame, path = cost_summary(device_costs(landing.messages()), "1 hour", "1 hour"), f"{landing.folder}/revisions"
    landing.run(frame, revisions(path), "update")
    landing.deliver(cost("05:00:01", 4))
    landing.run(frame, revisions(path), "update")
    assert {r["run_id"] for r in read_revisions(spark, path, COST_SUMMARY).collect()} == {1}
    batches = read_revisions(spark, path, COST_SUMMARY).agg(F.max("batch_id")).first()[0]
    assert batches >= 1
    landing.run(frame, revisions(path), "update", "another")
    stored = read_revisions(spark, path, COST_SUMMARY)
    last = latest_revision(stored, ("timestamp", "DID", "DSN")).collect()
    assert {(r["timestamp"].hour, r["total_cost"], r["run_id"], r["batch_id"]) for r in last} == {(0, 1.0, 2, 0), (5, 6.0, 2, 0)}


def test_files_of_a_batch_follow_its_size(spark, landing):
    landing.deliver(*(cost(f"{h:02}:00:00", 1, day) for h in range(24) for day in ("01", "02")))
    frame = cost_summary(device_costs(landing.messages()), "1 hour", "1 hour")
    landing.run(frame, revisions(f"{landing.folder}/a"), "update")
    files = spark.read.parquet(f"{landing.folder}/a/revisions").inputFiles()
    assert len(files) == 2  # one for each day, whatever the number of state partitions
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_deltas_add_up_whatever_the_batches(spark, landing):
    P.device(P.events(spark, FOLDER)).repartition(4).write.mode("append").text(f"{landing.folder}/landing")
    lost = []

    def stage(batch, staged):
        stage_grains(batch, staged)
        if staged.batch_id == 2 and not lost:
            lost.append(staged)
            raise RuntimeError("lost")

    frame, path = device_readings(landing.messages(maxFilesPerTrigger="1")), f"{landing.folder}/deltas"
    with pytest.raises(StreamingQueryException, match="lost"):
        landing.run(frame, committed(path, stage))
    landing.run(frame, committed(path, stage))
    want = sorted(cost_grains(device_costs(P.device(P.events(spark, FOLDER)))).collect())
    assert sorted(read_delta_grains(spark, path).collect()) == want
    # A new checkpoint over the same messages, in other batches, counts them once.
    landing.run(device_readings(landing.messages(maxFilesPerTrigger="3")), committed(path, stage), checkpoint="another")
    assert sorted(read_delta_grains(spark, path).collect()) == want
    twice = read_delta_grains(spark, path, all_runs=True).where("grain = '1d'").agg(F.sum("total_cost")).first()[0]
    once = read_delta_grains(spark, path).where("grain = '1d'").agg(F.sum("total_cost")).first()[0]
    assert twice == pytest.approx(2 * once)


def test_deltas_parse_a_message_once(spark, landing):
    landing.deliver(cost("00:00:01", 1))
    ((flow, sink),) = cost_deltas(landing.messages(), landing.folder)
    plan = flow.frame._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json") == 1
    plans = []

    def stage(batch, staged):
        stage_grains(batch, staged)
        readings = batch.sparkSession.read.schema(batch.schema).parquet(staged.table("readings"))
        plans.append(cost_grains(readings.select("STIME", "DID", "DSN", "COST"))._jdf.queryExecution().executedPlan().toString())

    landing.run(flow.frame, committed(f"{landing.folder}/t", stage))
    assert "from_json" not in plans[0] and "KPWR" not in plans[0].split("ReadSchema")[1] and plans[0].count("Exchange") == 1


def test_resent_readings_count_once_in_deltas(spark, landing):
    ((flow, sink),) = cost_deltas(landing.messages(), landing.folder, resent="1 hour")
    for texts in ((cost("00:00:01", 1), cost("00:00:01", 1)), (cost("00:00:01", 1), cost("00:10:00", 2))):
        landing.deliver(*texts)
        landing.run(flow.frame, sink)
    days = read_delta_grains(spark, f"{landing.folder}/cost_deltas").where("grain = '1d'")
    assert [r["total_cost"] for r in days.collect()] == [3.0]


def test_what_comes_too_late_is_beside_the_sums(spark, landing):
    path, frame = f"{landing.folder}/sums", device_costs(landing.messages())
    deliveries = [
        [cost("00:00:01", 1), cost("02:10:00", 2), "no json"],  # nothing is closed in the first batch
        [cost("00:00:02", 4), cost("00:59:59", 8), cost("01:00:00", 16)],  # 02:10 less an hour: the first hour is closed
        [cost("01:30:00", 32), cost("09:00:00", 64)],
        [cost("07:59:59", 128), cost("08:00:00", 256), cost("x", 512)],
    ]
    for texts in deliveries:
        landing.deliver(*texts)
        landing.run(frame, closing_sums(path, "1 hour", "1 hour"))
    sums = {r["timestamp"].hour: r["total_cost"] for r in read_closing_sums(spark, path).collect()}
    assert sums == {0: 1.0, 1: 48.0, 2: 2.0, 8: 256.0, 9: 64.0}
    others = read_readings(spark, path, READING, "late", "no_time").collect()
    assert sorted((r["reason"], r["COST"]) for r in others if r["COST"]) == [("late", 4.0), ("late", 8.0), ("late", 128.0), ("no_time", 512.0)]
    marks = read_marks(spark, path).orderBy("batch_id").collect()
    assert [(r["on_time"], r["late"], r["no_time"]) for r in marks] == [(2, 0, 1), (1, 2, 0), (2, 0, 0), (1, 1, 1)]
    assert [r["closed_before"] and r["closed_before"].hour for r in marks] == [None, 1, 1, 8]
    assert sum(r["on_time"] + r["late"] + r["no_time"] for r in marks) == read_readings(spark, path, READING).count() == 11


def test_closing_sums_agree_with_a_watermark(spark, landing):
    """What a stateful summary drops, which a listener counts, is what closing_sums puts beside."""
    path, readings = f"{landing.folder}/sums", device_costs(landing.messages())
    summary, table = cost_summary(readings, "1 hour", "1 hour"), f"{landing.folder}/revisions"
    with progress_log(spark) as log:
        for texts in ([cost("00:00:01", 1), cost("05:00:00", 2)], [cost("00:30:00", 4), cost("06:00:00", 8)], [cost("01:00:00", 16)]):
            landing.deliver(*texts)
            landing.run(readings, closing_sums(path, "1 hour", "1 hour"), checkpoint="a")
            landing.run(summary, revisions(table), "update", "b")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stateful = latest_revision(read_revisions(spark, table, COST_SUMMARY), ("timestamp", "DID", "DSN"))
    columns = ["timestamp", "DID", "DSN", "total_cost"]
    assert sorted(stateful.select(columns).collect()) == sorted(read_closing_sums(spark, path).select(columns).collect())
    assert sum(p.rows_dropped for p in log.records) == 2 == read_readings(spark, path, READING, "late").count()
    assert {p.query for p in log.records} == {"flow"} and any(p.watermark and "05:00" in p.watermark for p in log.records)


def test_first_copies_go_out_at_once_and_state_is_bounded(spark, landing):
    def meter(time, watt):
        return f'{{"date_time":"2024-01-01 {time}","id":"1","P (watt)":{watt}}}'

    frame, table = drop_resent_at_once(meter_readings(landing.messages()), delay="1 minute"), f"{landing.folder}/table"
    sent, counts = [], []
    for minute in range(0, 30, 5):
        sent += [meter(f"00:{minute:02}:00", 1), meter(f"00:{minute:02}:00", 2)]
        landing.deliver(*sent, *sent)
        landing.run(frame, parquet(table))
        counts.append(spark.read.parquet(table).count())
    assert counts == [2, 4, 6, 8, 10, 12]
    assert spark.read.format("statestore").load(f"{landing.folder}/checkpoint/flow").count() <= 4
    nulls = ['{"date_time":"2024-01-01 01:00:00","id":"x"}', '{"date_time":"2024-01-01 01:00:00","city":"x"}']
    landing.deliver(*nulls)
    landing.run(frame, parquet(table))
    assert spark.read.parquet(table).count() == 14  # fields that are missing tell readings apart


def test_a_stream_sees_the_table_of_its_batch(spark, landing):
    cities = f"{landing.folder}/cities"
    spark.createDataFrame([("1", "A")], "id STRING, city STRING").write.parquet(cities)
    frame = meter_readings(landing.messages()).drop("city")
    sink = looked_up(f"{landing.folder}/t", lambda session: session.read.schema("id STRING, city STRING").parquet(cities))
    for _ in range(2):
        landing.deliver('{"date_time":"2024-01-01 00:00:01","id":"1"}', '{"date_time":"2024-01-01 00:00:01","id":"2"}')
        landing.run(frame, sink)
        spark.createDataFrame([("2", "B")], "id STRING, city STRING").write.mode("append").parquet(cities)
    rows = read_committed(spark, f"{landing.folder}/t", "readings", "id STRING, city STRING").collect()
    found = sorted((r["batch_id"], r["id"], r["city"]) for r in rows if r["city"] or r["id"] == "2")
    first, last = min(r["batch_id"] for r in rows), max(r["batch_id"] for r in rows)
    assert found == [(first, "1", "A"), (first, "2", None), (last, "1", "A"), (last, "2", "B")]
