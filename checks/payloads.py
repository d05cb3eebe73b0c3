"""JSON messages derived from the `events` table, one or more per event, so that work grows with the table.

The figures are integer arithmetic on `event_id`, which `oracles.py` repeats in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetry.schemas import CITIES

CITY_NAMES = ", ".join(f"'{name}'" for name in CITIES.values())
METER_FIELDS = """
    'date_time', date_format(timestamp_seconds(1704067200 + {id} * 2), 'yyyy-MM-dd HH:mm:ss'),
    'id', cast({id} % 5 + 1 as string),
    'city', element_at(array({cities}), cast({id} % 5 + 1 as int)),
    'P (watt)', cast(200 + ({id} * 7) % 151 as int),
    'V (volt)', cast(100 + ({id} * 13) % 101 as int),
    'I (amphere)', ({current}) / 100D
"""
CURRENT = """
    (200 * (200 + ({id} * 7) % 151) + 100 + ({id} * 13) % 101) div (2 * (100 + ({id} * 13) % 101))
"""
DEVICE_FIELDS = """
    'CCD', 'C1', 'COST', {cost}, 'DID', cast(user_id % 20 as int), 'DSN', concat('SN-', user_id % 20),
    'ID', cast(event_id as int), 'KPWR', {power}cast((event_id * 7) % 151 as int),
    'KPWS', cast((event_id * 11) % 151 as int), 'KPWT', cast((event_id * 13) % 151 as int),
    'LAMPWH', cast(event_id % 50 as int), 'SN', concat('L-', event_id % 100),
    'STIME', date_format(ts, 'yyyy-MM-dd HH:mm:ss')
"""
LAMP_FIELDS = """
    'id_kWh', cast(event_id % 6 + 1 as int), 'city', if(event_id % 6 < 3, 'Surabaya', 'Sidoarjo'),
    'watt', cast((event_id * 7) % 101 as int), 'I', ((event_id * 17) % 1481 + 20) / 100D,
    'timestamp', date_format(ts, 'yyyy-MM-dd HH:mm:ss')
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def spread(rows: DataFrame) -> DataFrame:
    """The same rows dealt over all tasks: a file of few row groups is read by as few, which would then make and parse all
    messages."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def meter_fields(event_id: str = "event_id", drift: str = "0") -> str:
    current = f"{CURRENT.format(id=event_id)} + {drift}"
    return f"named_struct({METER_FIELDS.format(id=event_id, current=current, cities=CITY_NAMES)})"


def meter(rows: DataFrame, drift: str = "0") -> DataFrame:
    """One reading per event, two seconds apart. `drift` is added to the current, in hundredths."""
    return rows.select(F.expr(f"to_json({meter_fields(drift=drift)})").alias("value"))


def meter_array(rows: DataFrame) -> DataFrame:
    """One message per event, an array of five readings."""
    fields = meter_fields("(event_id * 5 + k)")
    return rows.select(F.expr(f"to_json(transform(sequence(0, 4), k -> {fields}))").alias("value"))


def device_fields(cost: str = "value", half_watts: bool = False) -> str:
    power = "0.5D + " if half_watts else ""
    return f"named_struct({DEVICE_FIELDS.format(cost=cost, power=power)})"


def device(rows: DataFrame, cost: str = "value", half_watts: bool = False) -> DataFrame:
    """One device reading per event; `half_watts` makes KPWR a fraction."""
    return rows.select(F.expr(f"to_json({device_fields(cost, half_watts)})").alias("value"))


def device_without_some_costs(rows: DataFrame) -> DataFrame:
    """The COST key is absent from every 89th message."""
    return device(rows, cost="if(event_id % 89 = 0, null, value)")


def device_with_bad_messages(rows: DataFrame) -> DataFrame:
    """Some messages are no JSON, some have no body, some a power figure that is no number."""
    good = f"to_json({device_fields()})"
    odd = "regexp_replace({}, '\"KPWR\":[0-9]+', '\"KPWR\":\"?\"')".format(good)
    return rows.select(
        F.expr(
            f"""case when event_id % 97 = 0 then 'not json' when event_id % 101 = 0 then null
                     when event_id % 103 = 0 then '' when event_id % 107 = 0 then {odd} else {good} end"""
        ).alias("value")
    )


def device_arrays(rows: DataFrame) -> DataFrame:
    """An array of a good element and one with a power figure that is no number; some messages are no JSON or broken off."""
    good = f"to_json({device_fields()})"
    odd = "regexp_replace({}, '\"KPWR\":[0-9]+', '\"KPWR\":\"?\"')".format(good)
    return rows.select(
        F.expr(
            f"""case when event_id % 97 = 0 then 'not json' when event_id % 101 = 0 then concat('[', {good}, ',')
                     else concat('[', {good}, ',', {odd}, ']') end"""
        ).alias("value")
    )


def device_mixed(rows: DataFrame) -> DataFrame:
    """All that a sender may send: objects, arrays of a good element and an odd one, empty arrays, numbers, and no JSON."""
    good = f"to_json({device_fields()})"
    odd = "regexp_replace({}, '\"KPWR\":[0-9]+', '\"KPWR\":\"?\"')".format(good)
    return rows.select(
        F.expr(
            f"""case when event_id % 97 = 0 then 'not json' when event_id % 101 = 0 then concat('[', {good}, ',')
                     when event_id % 103 = 0 then '[]' when event_id % 107 = 0 then '17' when event_id % 109 = 0 then null
                     when event_id % 2 = 0 then {good} else concat('[', {good}, ',', {odd}, ']') end"""
        ).alias("value")
    )


def lamp(rows: DataFrame) -> DataFrame:
    return rows.select(F.expr(f"to_json(named_struct({LAMP_FIELDS}))").alias("value"))


def resent(messages: DataFrame) -> DataFrame:
    """Every message three times."""
    return messages.select(F.explode(F.array_repeat("value", 3)).alias("value"))
