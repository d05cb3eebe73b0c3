import datetime

import pytest

from lumetry.functions import (
    device_readings,
    event_time,
    lamp_readings,
    meter_readings,
    nonempty,
    parse,
    elements,
    parse_array,
    payload_text,
    to_document,
    with_cost_default,
    with_parse_status,
)
from lumetry.schemas import DEVICE_FLOAT, DEVICE_INT, METER

GOOD = '{"date_time":"2024-01-01 00:00:01","id":"1","city":"Gresik","P (watt)":250,"V (volt)":100,"I (amphere)":2.5}'
NOTHING = (None,) * 6


def rows(frame):
    return [tuple(row) for row in frame.collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        (GOOD, ("2024-01-01 00:00:01", "1", "Gresik", 250, 100, 2.5)),
        ("not json", NOTHING),
        ("", NOTHING),
        (None, NOTHING),
        ("{}", NOTHING),
        ("[1]", NOTHING),
        ('{"id":"7","extra":1}', (None, "7", None, None, None, None)),
        ('{"id":"7","P (watt)":"x"}', (None, "7", None, None, None, None)),
        ('{"id":"7","P (watt)":250.7}', (None, "7", None, None, None, None)),
        ('{"id":"7","V (volt)":9}', (None, "7", None, None, 9, None)),
        ('{"id":"7"', NOTHING),
    ],
)
def test_parse_keeps_one_row_per_message(messages, text, expected):
    assert rows(parse(messages([text]), METER)) == [expected]


def test_parse_reads_bytes(spark, messages):
    as_bytes = messages([GOOD]).selectExpr("cast(value as binary) as value")
    assert rows(payload_text(as_bytes)) == [(GOOD,)]
    assert rows(parse(as_bytes, METER))[0][1] == "1"


@pytest.mark.parametrize("text", ["yesterday", "2024-13-01 00:00:00", "", None])
def test_bad_time_is_null(messages, text):
    assert rows(messages([text]).select(event_time("value"))) == [(None,)]


def test_times_keep_fractions_and_accept_dates(messages):
    times = messages(["2024-01-01 00:00:01.5", "2024-01-02"]).select(event_time("value"))
    assert rows(times) == [(datetime.datetime(2024, 1, 1, 0, 0, 1, 500000),), (datetime.datetime(2024, 1, 2),)]


def test_power_figures_of_both_device_schemas(messages):
    source = messages(['{"DID":1,"KPWR":250.7,"KPWS":3}'])
    assert rows(device_readings(source, DEVICE_INT).select("DID", "KPWR", "KPWS")) == [(1, None, 3)]
    floats = rows(device_readings(source, DEVICE_FLOAT).select("DID", "KPWR", "KPWS"))
    assert floats == [(1, pytest.approx(250.7, abs=1e-4), 3.0)]


def test_lamp(messages):
    source = messages(['{"id_kWh":4,"city":"Sidoarjo","watt":55,"I":0.5,"timestamp":"2024-02-28 00:00:02"}'])
    assert rows(lamp_readings(source)) == [(4, "Sidoarjo", 55, 0.5, datetime.datetime(2024, 2, 28, 0, 0, 2))]


def test_cost_default(messages):
    source = messages(['{"DID":1}', '{"DID":2,"COST":null}', '{"DID":3,"COST":1.5}'])
    costs = with_cost_default(device_readings(source)).select("DID", "COST")
    assert rows(costs) == [(1, 0.0), (2, 0.0), (3, 1.5)]
    assert dict(costs.dtypes)["COST"] == "float"


def test_nonempty(messages):
    assert rows(nonempty(messages(["a", "", None, " "]))) == [("a",), (" ",)]


def test_arrays(messages):
    array = f"[{GOOD},{GOOD.replace('Gresik', 'Malang')}]"
    cities = parse_array(messages([array, GOOD, "not json", "[]"]), METER).select("city")
    assert rows(cities) == [("Gresik",), ("Malang",), ("Gresik",), (None,), (None,)]


def test_elements_lose_no_message(messages):
    sent = [f"[{GOOD}, {GOOD}]", GOOD, "not json", None, "", f"[{GOOD},", '[{"P (watt)":"x"}]']
    found = with_parse_status(elements(messages(sent)), METER)
    assert [r["status"] for r in found.collect()] == [
        "ok", "ok", "ok", "malformed", "empty", "empty", "malformed", "bad_fields",
    ]


def test_documents_parse_back(messages):
    readings = parse(messages([GOOD]), METER)
    assert rows(parse(to_document(readings).toDF("value"), METER)) == rows(readings)


@pytest.mark.parametrize(
    "text, status",
    [
        (GOOD, "ok"),
        ("{}", "ok"),
        ("", "empty"),
        ("  ", "empty"),
        (None, "empty"),
        ("not json", "malformed"),
        ('{"id":"7"', "malformed"),
        ('{"id":"7","P (watt)":"x"}', "bad_fields"),
        ("[1, 2]", "bad_fields"),
        ("5", "bad_fields"),
    ],
)
def test_status(messages, text, status):
    found = with_parse_status(messages([text]), METER)
    assert rows(found.select("value", "status")) == [(text, status)]


def test_status_keeps_the_fields_that_fit(messages):
    found = with_parse_status(messages(['{"id":"7","P (watt)":"x"}']), METER)
    assert rows(found.select("id", "`P (watt)`")) == [("7", None)]


def test_rows_without_a_time_stay_in_the_raw_readings(messages):
    assert meter_readings(messages(["not json", GOOD])).count() == 2
