import datetime

import pytest

from checks import payloads as P
from lumetry.functions import device_costs, meter_readings
from lumetry.operators import (
    cost_grains,
    cost_summary,
    drop_resent,
    grown,
    latest_revision,
    meter_summary,
    rollup_of_totals,
    with_city,
    with_derived_current,
    with_out_of_band,
)
from lumetry.operators.summaries import BY_METER, meter_report, windowed_sums
from lumetry.functions import METER_MEASURES
from lumetry.schemas import LAMP_BAND

METER = "date_time TIMESTAMP, id STRING, city STRING, `P (watt)` INT, `V (volt)` INT, `I (amphere)` FLOAT"
COST = "STIME TIMESTAMP, DID INT, DSN STRING, COST FLOAT"


def at(text):
    return datetime.datetime.fromisoformat(f"2024-01-{text}")


def test_means_skip_missing_figures_and_groups_without_any_are_null(spark):
    readings = spark.createDataFrame(
        [
            (at("01 00:00:01"), "1", "a", 10, None, None),
            (at("01 00:00:59"), "1", "a", None, None, 0.5),
            (at("01 00:01:00"), "1", "a", 7, 3, 0.25),
            (None, "1", "a", 1000, 1000, 1000.0),
        ],
        METER,
    )
    rows = meter_summary(readings, "1 minute").orderBy("timestamp").collect()
    assert [tuple(r)[3:] for r in rows] == [(10, None, 0.5, 10.0, None, 0.5), (7, 3, 0.25, 7.0, 3.0, 0.25)]


def test_hot_device_among_many(spark):
    """One device sends a third of all readings."""
    readings = spark.range(30_000).selectExpr(
        "timestamp_seconds(1704067200 + id % 7200) as STIME",
        "cast(if(id % 3 = 0, 0, id % 500) as int) as DID",
        "'x' as DSN",
        "cast((id % 1000) / 100 as float) as COST",
    )
    total = cost_summary(readings, "1 hour").selectExpr("round(sum(total_cost), 2)").first()[0]
    assert total == round(sum((i % 1000) / 100 for i in range(30_000)), 2)


def test_each_grain_equals_its_own_summary(spark):
    readings = device_costs(P.device(P.events(spark, "/root/testdata/sf0.001")))
    grains = cost_grains(readings)
    for grain, length in (("1m", "1 minute"), ("1h", "1 hour"), ("1d", "1 day")):
        rows = grains.where(f"grain = '{grain}'").drop("grain").collect()
        assert sorted(rows) == sorted(cost_summary(readings, length).collect())


def test_grains_keep_devices_without_a_name(spark):
    readings = spark.createDataFrame([(at("01 00:00:01"), None, None, 1.5), (at("01 00:00:02"), 1, None, 2.0)], COST)
    rows = cost_grains(readings).collect()
    assert len(rows) == 6
    assert sum(r["total_cost"] for r in rows) == 10.5


def test_rolled_up_totals_equal_the_direct_summary(spark):
    readings = meter_readings(P.meter(P.events(spark, "/root/testdata/sf0.001")))
    minutes = windowed_sums(readings, "date_time", "1 minute", BY_METER, METER_MEASURES)
    rolled = meter_report(rollup_of_totals(minutes, "5 minutes", BY_METER, METER_MEASURES), BY_METER)
    assert sorted(rolled.collect()) == sorted(meter_summary(readings, "5 minutes").collect())


def test_days_can_begin_at_a_local_midnight(spark):
    readings = spark.createDataFrame(
        [(at("01 16:59:59"), 1, "a", 1.0), (at("01 17:00:00"), 1, "a", 2.0), (at("02 16:00:00"), 1, "a", 4.0)], COST
    )
    rows = cost_summary(readings, "1 day", offset="17 hours").orderBy("timestamp").collect()
    assert [(r["timestamp"].hour, r["total_cost"]) for r in rows] == [(17, 1.0), (17, 6.0)]


def test_latest_revision_takes_the_highest_number_also_when_it_is_null(spark):
    stored = [("a", 1, 5.0), ("a", 10, 7.0), ("a", 9, 6.0), ("b", 2, None), ("b", 1, 1.0)]
    table = spark.createDataFrame(stored, "k STRING, batch_id BIGINT, v DOUBLE")
    rows = {r["k"]: (r["v"], r["batch_id"]) for r in latest_revision(table, ["k"]).collect()}
    assert rows == {"a": (7.0, 10), "b": (None, 2)}


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_city_lookup_keeps_unknown_ids(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    cities = spark.range(20).selectExpr("cast(id as string) as id", "concat('c', id) as city")
    readings = spark.range(3000).selectExpr("id as n", "cast(if(id % 3 = 0, 7, id % 25) as string) as id")
    found = with_city(readings, cities)
    assert sorted(found.columns) == ["city", "id", "n"]
    known = sum(1 for i in range(3000) if (7 if i % 3 == 0 else i % 25) < 20)
    assert (found.count(), found.where("city is not null").count()) == (3000, known)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.where("city <> concat('c', id)").count() == 0


def test_derived_current(spark):
    readings = spark.createDataFrame(
        [
            (None, "1", "a", 250, 200, 1.25),
            (None, "2", "a", 250, 100, 2.51),
            (None, "3", "a", 250, 0, 1.0),
            (None, "4", "a", 25, 200, 0.12),
            (None, "5", "a", 25, 200, 0.13),
            (None, "6", "a", None, 200, 0.13),
        ],
        METER,
    )
    rows = {r["id"]: (r["derived_amphere"], r["consistent"]) for r in with_derived_current(readings).collect()}
    assert rows == {
        "1": (1.25, True),
        "2": (2.5, False),
        "3": (None, None),
        "4": (0.13, True),  # 0.125 may be rounded either way
        "5": (0.13, True),
        "6": (None, None),
    }


def test_band_edges_belong_to_the_band(spark):
    flags = with_out_of_band(spark.createDataFrame([(39,), (40,), (70,), (71,), (None,)], "watt INT"), "watt", LAMP_BAND)
    assert [r["out_of_band"] for r in flags.collect()] == [True, False, False, True, None]


def test_copies_differ_in_no_field(spark):
    row = (at("01 00:00:01"), "1", "a", 1, 1, 1.0)
    readings = spark.createDataFrame([row, row, (*row[:3], 2, 1, 1.0), (None,) * 6, (None,) * 6], METER)
    assert drop_resent(readings).count() == 3


def test_growing_keeps_duplicates(spark):
    rows = spark.createDataFrame([(1, "a")], "x INT, y STRING")
    assert grown(grown(rows.limit(0), rows), rows.select("y", "x")).collect() == rows.union(rows).collect()
