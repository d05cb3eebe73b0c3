"""Messages as VARIANT: what is told apart, and that each text is parsed once."""

import pytest
from pyspark.sql import functions as F

from checks import payloads as P
from lumetry.functions import as_variants, parse, variant_elements, variant_readings
from lumetry.plans import PIPELINES, landed_checked
from lumetry.schemas import DEVICE_FLOAT, DEVICE_INT, METER
from lumetry.session import shared_folder
from lumetry.sources import landed_messages

SCHEMA = "a INT, b FLOAT, `P (w)` INT, s STRING"
FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "text, found",
    [
        ('{"a":1,"b":2.5,"P (w)":3,"s":"x"}', [("ok", 1, 2.5, 3, "x")]),
        ('{"a":1}', [("ok", 1, None, None, None)]),
        ('{"a":null,"other":[1]}', [("ok", None, None, None, None)]),
        ('{"b":7}', [("ok", None, 7.0, None, None)]),
        ('{"a":"12"}', [("bad_fields", None, None, None, None)]),
        ('{"a":250.7,"s":"x"}', [("bad_fields", None, None, None, "x")]),
        ('{"a":99999999999}', [("bad_fields", None, None, None, None)]),
        ('{"a":{"b":1}}', [("bad_fields", None, None, None, None)]),
        ('[{"a":1},{"a":"?"}]', [("ok", 1, None, None, None), ("bad_fields", None, None, None, None)]),
        ('[{"a":1},5,[]]', [("ok", 1, None, None, None), ("no_object", None, None, None, None), ("no_elements", None, None, None, None)]),
        ("[]", [("no_elements", None, None, None, None)]),
        ("5", [("no_object", None, None, None, None)]),
        ("null", [("no_object", None, None, None, None)]),
        ("not json", [("malformed", None, None, None, None)]),
        ('[{"a":1},', [("malformed", None, None, None, None)]),
        ("", [("empty", None, None, None, None)]),
        ("  ", [("empty", None, None, None, None)]),
        (None, [("empty", None, None, None, None)]),
    ],
)
def test_what_a_message_holds(messages, text, found):
    rows = variant_readings(variant_elements(as_variants(messages([text]))), SCHEMA).collect()
    assert sorted((r["status"], r["a"], r["b"], r["P (w)"], r["s"]) for r in rows) == sorted(found)


@pytest.mark.parametrize("schema, payload", [(DEVICE_INT, P.device), (DEVICE_FLOAT, P.device), (METER, P.meter)])
def test_fields_are_those_of_a_schema(spark, schema, payload):
    sent = payload(P.events(spark, FOLDER))
    fields = variant_readings(as_variants(sent), schema)
    assert {r["status"] for r in fields.select("status").distinct().collect()} == {"ok"}
    assert sorted(fields.drop("value", "status").collect()) == sorted(parse(sent, schema).collect())


def test_a_message_is_parsed_once(spark):
    folder = shared_folder(spark)
    P.device_mixed(P.events(spark, FOLDER)).write.text(folder)
    checked = variant_readings(variant_elements(as_variants(landed_messages(spark, folder, stream=False))), DEVICE_FLOAT)
    for frame in (checked, checked.where("status = 'ok' AND KPWR > 3"), checked.where("status <> 'ok'")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson") == 1 and "from_json" not in plan


def test_landed_messages_are_parsed_by_the_first_flow_only(spark):
    folder = shared_folder(spark)
    flows = landed_checked(spark, P.device_mixed(P.event_stream(spark, FOLDER)), folder)
    plans = [flow.frame._jdf.queryExecution().analyzed().toString() for flow, _ in flows]
    assert [plan.count("parse_json") for plan in plans] == [1, 0, 0, 0]
    assert [flow.name for flow, _ in flows] == ["raw_messages", "raw_checked", "raw_quarantine", "cost_1h"]
    assert all("from_json" not in f.frame._jdf.queryExecution().analyzed().toString() for f in PIPELINES["checked_device"](
        P.device_mixed(P.event_stream(spark, FOLDER))
    ))


MIXED = ['{"a":1,"s":"x"}', '[{"a":1},{"a":"?"},null]', '[{"b":{"c":2}}]', "[]", "5", "null", "not json", '[{"a":1},', "", "  ", None]


def test_elements_are_parted_by_the_readings_too(messages):
    sent = as_variants(messages(MIXED))
    expected = variant_readings(variant_elements(sent), SCHEMA)
    landed = sent.withColumn("value", F.when(F.col("content").isNull(), F.col("value")))
    for frame in (sent, landed):
        found = variant_readings(frame, SCHEMA, elements=True)
        assert found.columns == expected.columns
        key = lambda r: tuple(map(str, r))
        assert sorted(found.collect(), key=key) == sorted(expected.collect(), key=key)


def test_good_readings_are_not_written_as_json(messages):
    """Neither the elements nor the messages: only what is set aside needs its text."""
    sent = as_variants(messages(MIXED))
    checked = variant_readings(sent, SCHEMA, elements=True)
    good = checked.where("status = 'ok'").drop("value", "status")
    assert "StructsToJson" not in good._jdf.queryExecution().executedPlan().toString()
    plan = checked.where("status <> 'ok'").select("value", "status")._jdf.queryExecution().executedPlan().toString()
    written = [i for i, line in enumerate(plan.splitlines()) if "StructsToJson" in line]
    assert len(written) == 1 and written[0] < next(i for i, line in enumerate(plan.splitlines()) if "Filter" in line)


def test_a_field_is_looked_up_for_the_status_only_where_it_is_missing(messages):
    status = variant_readings(as_variants(messages(MIXED)), SCHEMA).select("status")
    plan = status._jdf.queryExecution().executedPlan().toString()
    (line,) = [line for line in plan.splitlines() if "Generate explode" in line]
    assert "$['a'], IntegerType" not in line and "$['a'], VariantType" in line


def test_checked_messages_are_dealt_over_all_tasks(spark):
    """A file of one row group is read by one task, which is not to make and check all messages."""
    rows = P.spread(P.events(spark, FOLDER).coalesce(1))
    counts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(counts) <= 2 * min(counts)
    assert sorted(rows.collect()) == sorted(P.events(spark, FOLDER).collect())
