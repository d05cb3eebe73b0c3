"""What the plans must look like to hold up at volume."""

import pytest

from checks import payloads as P
from checks.queries import QUERIES
from lumetry.functions import device_costs, meter_readings, with_parse_status
from lumetry.operators import cost_grains, cost_summary, drop_resent, latest_revision, meter_summary
from lumetry.plans import PIPELINES
from lumetry.schemas import METER
from lumetry.sinks import merge_bucketed, merged, revisions, write_bucketed
from lumetry.sources import landed_messages
from lumetry.session import shared_folder
from lumetry.streaming import start


@pytest.fixture(scope="module")
def landed(spark):
    folder = shared_folder(spark)
    P.meter(P.events(spark, "/root/testdata/sf0.001")).write.text(folder)
    return landed_messages(spark, folder, stream=False)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_messages_are_parsed_once(landed):
    for frame in (
        meter_summary(meter_readings(landed), "1 minute"),
        cost_summary(device_costs(landed), "1 hour"),
        meter_readings(landed).where("date_time is not null and id = '1'"),
        with_parse_status(landed, METER).where("status = 'ok'"),
        cost_grains(device_costs(landed)),
    ):
        assert plan(frame).count("from_json") == 1


def test_summaries_fold_readings_before_their_only_shuffle(landed):
    for frame in (
        meter_summary(meter_readings(landed), "1 minute"),
        cost_summary(device_costs(landed), "1 hour"),
        cost_grains(device_costs(landed)),
    ):
        text = plan(frame)
        assert text.count("Exchange") == 1
        assert "partial_sum" in text.split("Exchange")[1]
        assert "SortAggregate" not in text and "Sort " not in text


def test_streams_fold_readings_before_the_shuffle_too(spark, capsys):
    folder = shared_folder(spark)
    P.meter(P.events(spark, "/root/testdata/sf0.001")).write.text(f"{folder}/landing")
    (flow,) = PIPELINES["meter_1m"](landed_messages(spark, f"{folder}/landing"))
    query = start(flow, revisions(f"{folder}/table"), folder, available_now=True)
    query.awaitTermination()
    query.explain()
    text = capsys.readouterr().out
    assert text.count("Exchange") == 1 and text.count("from_json") == 1
    assert "partial_sum" in text.split("Exchange")[1] and "StateStoreSave" in text.split("Exchange")[0]


def test_copies_fold_before_the_shuffle(landed):
    text = plan(drop_resent(meter_readings(landed)))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_revisions_fold_before_the_shuffle(spark):
    table = spark.createDataFrame([("a", 1, 5.0)], "k STRING, batch_id BIGINT, v DOUBLE")
    text = plan(latest_revision(table, ["k"]))
    assert "partial_max_by" in text and "SortAggregate" not in text and "Window" not in text


def test_cost_summaries_parse_four_fields(landed):
    text = plan(cost_summary(device_costs(landed), "1 hour"))
    assert "KPWR" not in text


@pytest.mark.parametrize("name", ["agg_meter_1m", "agg_city_5m", "agg_cost_1h", "agg_cost_grains"])
def test_registered_summaries_shuffle_once(spark, name):
    assert plan(QUERIES[name](spark, "/root/testdata/sf0.001")).count("Exchange") == 1


def test_scans_read_the_needed_columns_only(spark):
    text = plan(QUERIES["agg_meter_1m"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_bucketed_summaries_merge_without_a_shuffle(spark):
    folder, keys = shared_folder(spark), ["k", "s"]
    name = f"merge_{folder.rpartition('-')[2]}"
    schema = "k INT, s STRING, v DOUBLE, run_id BIGINT, batch_id BIGINT"
    first = spark.createDataFrame([(k, "a", 1.0, 1, 0) for k in range(30)] + [(None, "a", 1.0, 1, 0)], schema)
    second = spark.createDataFrame([(k, "a", 2.0, 1, 1) for k in range(20, 40)] + [(None, "a", 2.0, 1, 1)], schema)
    merge_bucketed(spark, name, folder, first, keys, 4)
    table = merge_bucketed(spark, name, folder, second, keys, 4)
    assert {(r["k"], r["v"]) for r in table.collect()} == {(k, 1.0 if k < 20 else 2.0) for k in range(40)} | {(None, 2.0)}
    assert table.count() == 41 == spark.table(name).count()
    fresh = write_bucketed(second, f"{name}_other", f"{folder}/other", keys, 4)
    for frame in (merged(spark.table(name).drop("version"), fresh, keys), table.groupBy(*keys).count()):
        assert "Exchange" not in plan(frame)
