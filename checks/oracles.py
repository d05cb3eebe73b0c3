"""The registered queries in DuckDB SQL."""

from __future__ import annotations

from lumetry.schemas import CITIES

_CITY_NAMES = ", ".join(f"'{name}'" for name in CITIES.values())

# Integer arithmetic on `id` as in payloads.py; `ic` is the current in hundredths.
_METER = """
    select make_timestamp((1704067200 + {id} * 2) * 1000000) as date_time,
           cast({id} % 5 + 1 as varchar) as id,
           ([{cities}])[{id} % 5 + 1] as city,
           cast(200 + ({id} * 7) % 151 as integer) as p,
           cast(100 + ({id} * 13) % 101 as integer) as v,
           (200 * (200 + ({id} * 7) % 151) + 100 + ({id} * 13) % 101)
             // (2 * (100 + ({id} * 13) % 101)) as ic
    from {rows}
"""
METER = _METER.format(id="event_id", rows="events", cities=_CITY_NAMES)
ARRAY = _METER.format(
    id="n", rows="(select event_id * 5 + k as n from events, (select unnest(range(5)) as k))", cities=_CITY_NAMES
)

_READING = """
    select {time} as date_time, id, city, p as "P (watt)", v as "V (volt)", ic / 100.0::double as "I (amphere)"
    from ({source}) m
"""
_TEXT = "strftime(date_time, '%Y-%m-%d %H:%M:%S')"

DEVICE = """
    select 'C1' as "CCD", {cost} as "COST", cast(user_id % 20 as integer) as "DID",
           'SN-' || (user_id % 20) as "DSN", cast(event_id as integer) as "ID",
           {power} as "KPWR", cast((event_id * 11) % 151 as {kind}) as "KPWS",
           cast((event_id * 13) % 151 as {kind}) as "KPWT", cast(event_id % 50 as {kind}) as "LAMPWH",
           'L-' || (event_id % 100) as "SN", {time} as "STIME"
    from events
"""
_SECOND = "date_trunc('second', ts)"
_STIME = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def _device(kind: str = "integer", cost: str = "value", power: str = "(event_id * 7) % 151", time: str = _STIME) -> str:
    return DEVICE.format(cost=cost, kind=kind, power=f"cast({power} as {kind})", time=time)


# Half-up means of integer hundredths: figures are never negative here.
def _half_up(total: str, n: str = "count(*)") -> str:
    return f"((2 * {total} + {n}) // (2 * {n}))::double / 100"


def _meter_summary(minutes: int, keys: str, time_as: str = '"timestamp"') -> str:
    return f"""
        select strftime(time_bucket(interval '{minutes} minutes', date_time), '%Y-%m-%d %H:%M:%S') as {time_as},
               {keys}, cast(sum(p) as bigint) as total_watt, cast(sum(v) as bigint) as total_volt,
               cast(sum(ic) as bigint) / 100.0::double as total_amphere,
               {_half_up("sum(100 * p)")} as avg_watt, {_half_up("sum(100 * v)")} as avg_volt,
               {_half_up("sum(ic)")} as avg_amphere
        from ({METER}) m group by all
    """


def _hundredths(column: str) -> str:
    return f"sum(cast(round({column} * 100) as bigint))"


def _rollup(having: str = "") -> str:
    return f"""
        select strftime(w, '%Y-%m-%d %H:%M:%S') as "timestamp", id, city,
               cast(sum(total_watt) as bigint) as total_watt, cast(sum(total_volt) as bigint) as total_volt,
               cast({_hundredths("total_amphere")} as bigint) / 100.0::double as total_amphere,
               {_half_up(_hundredths("avg_watt"))} as avg_watt, {_half_up(_hundredths("avg_volt"))} as avg_volt,
               {_half_up(_hundredths("avg_amphere"))} as avg_amphere
        from (select time_bucket(interval '5 minutes', cast(minute as timestamp)) as w, *
              from ({_meter_summary(1, "id, city", "minute")}) a) b
        {having}
        group by w, id, city
    """


def _cost(grain: str, extra: str = "", where: str = "", bucket: str = "time_bucket(interval '{grain}', ts)") -> str:
    return f"""
        select {bucket.format(grain=grain)} as "timestamp", cast(user_id % 20 as integer) as "DID",
               'SN-' || (user_id % 20) as "DSN", cast(sum(cast(value as decimal(18,2))) as double) as total_cost{extra}
        from events {where} group by all
    """


def _closed(grain: str, delay: str) -> str:
    """Windows of which the end is `delay` behind the newest reading."""
    newest = f"(select max({_SECOND}) from events)"
    return f"where time_bucket(interval '{grain}', ts) + interval '{grain}' <= {newest} - interval '{delay}'"


def _flow(name: str, grain: str) -> str:
    return f"""
        select '{name}' as flow, count(*) as rows,
               cast(sum(cast(total_cost as decimal(18,2))) as double) as total_cost from ({_cost(grain)}) c
    """


_BAD = """
    case when event_id % 97 = 0 then 'malformed' when event_id % 101 = 0 or event_id % 103 = 0 then 'empty'
         when event_id % 107 = 0 then 'bad_fields' else 'ok' end
"""
_PARSED = f"{_BAD} in ('ok', 'bad_fields')"

_LAMP = """
    select cast(event_id % 6 + 1 as integer) as "id_kWh",
           case when event_id % 6 < 3 then 'Surabaya' else 'Sidoarjo' end as city,
           cast((event_id * 7) % 101 as integer) as watt, ((event_id * 17) % 1481 + 20) / 100.0::double as "I",
           date_trunc('second', ts) as "timestamp"
    from events
"""

_GRAINS = " union all ".join(
    f"select *, '{name}' as grain from ({_cost(grain)}) {alias}"
    for name, grain, alias in (("1m", "1 minute", "a"), ("1h", "1 hour", "b"), ("1d", "1 day", "c"))
)

# Each grain closes when a newer window of the grain below has arrived: minutes a day behind the newest reading.
_CASCADE = f"""
    with minutes as ({_cost("1 minute", where=_closed("1 minute", "1 day"))}),
         hours as (select time_bucket(interval '1 hour', "timestamp") as "timestamp", "DID", "DSN",
                          cast(sum(cast(total_cost as decimal(18,2))) as double) as total_cost
                   from minutes group by all),
         closed_hours as (select * from hours
                          where "timestamp" + interval '1 hour' <= (select max("timestamp") from minutes)),
         days as (select time_bucket(interval '1 day', "timestamp") as "timestamp", "DID", "DSN",
                         cast(sum(cast(total_cost as decimal(18,2))) as double) as total_cost
                  from closed_hours group by all),
         closed_days as (select * from days
                         where "timestamp" + interval '1 day' <= (select max("timestamp") from closed_hours))
    select *, '1m' as grain from minutes union all select *, '1h' from closed_hours
    union all select *, '1d' from closed_days
"""

_LATE = f"""
    with sent as (
        select *, {_SECOND} as t,
               case when day(ts) <= 10 and event_id % 10 = 0 then 2 when day(ts) <= 10 then 0
                    when day(ts) <= 20 and event_id % 10 = 5 then 2 when day(ts) <= 20 then 1 else 2 end as delivery
        from events),
    newest as (select d.delivery, (select max(t) from sent s where s.delivery < d.delivery) as before
               from (select unnest([0, 1, 2]) as delivery) d)
    select time_bucket(interval '1 hour', t) as "timestamp", cast(user_id % 20 as integer) as "DID",
           'SN-' || (user_id % 20) as "DSN", cast(sum(cast(value as decimal(18,2))) as double) as total_cost
    from sent join newest using (delivery)
    where before is null or time_bucket(interval '1 hour', t) + interval '1 hour' > before - interval '1 hour'
    group by all
"""

_METER_TEXT = _READING.format(time=_TEXT, source=METER)
_METER_TIMED = _READING.format(time="date_time", source=METER)
_DEVICE_TEXT = _device()

ORACLES: dict[str, str] = {
    "src_message_stream": _device("double", time=_SECOND),
    "src_message_stream_earliest": _METER_TIMED,
    "src_json_batch": _METER_TEXT,
    "src_json_stream": _METER_TIMED,
    "src_json_summary": _cost("1 hour"),
    "src_empty_schema": _DEVICE_TEXT,
    "prj_payload_text": "select props as value from events",
    "prj_parse_meter": _METER_TEXT,
    "prj_parse_device_int": _DEVICE_TEXT,
    "prj_parse_device_float": _device("double", power="0.5 + (event_id * 7) % 151"),
    "prj_device_cost_columns": f'select "STIME", "DID", "DSN", "COST" from ({_device(time=_SECOND)}) d',
    "prj_meter_columns": _METER_TIMED,
    "prj_event_time_meter": f"select id, date_time from ({METER}) m",
    "prj_event_time_device": f"""
        select case when {_PARSED} then cast(event_id as integer) end as "ID",
               case when {_PARSED} then {_SECOND} end as "STIME" from events
    """,
    "prj_cost_default": f"""
        select "ID", "DID", "COST" from ({_device(cost="case when event_id % 89 = 0 then 0.0::double else value end")}) d
    """,
    "prj_window_text": f"""
        select id, date_time, strftime(date_trunc('minute', date_time), '%Y-%m-%d %H:%M:%S') as "timestamp"
        from ({METER}) m
    """,
    "prj_round2": f"""
        select cast(user_id % 20 as integer) as "DID",
               cast(sum(cast(value as decimal(18,2))) as double) as total_cost,
               {_half_up("cast(sum(cast(value as decimal(18,2))) * 100 as bigint)")} as avg_cost
        from events group by 1
    """,
    "prj_row_to_document": _DEVICE_TEXT,
    "flt_nonempty_payload": f"""
        select case when {_PARSED} then cast(event_id as integer) end as "ID",
               case when {_BAD} = 'ok' then cast((event_id * 7) % 151 as integer) end as "KPWR",
               case when {_PARSED} then value end as "COST"
        from events where {_BAD} <> 'empty'
    """,
    "flt_event_time_present": f"""
        select cast(event_id as integer) as "ID", {_SECOND} as "STIME" from events where {_PARSED}
    """,
    "agg_meter_1m": _meter_summary(1, "id, city"),
    "agg_meter_5m_rollup": _rollup(),
    "agg_meter_5m_weighted": _meter_summary(5, "id, city"),
    "agg_city_1m": _meter_summary(1, "city"),
    "agg_city_5m": _meter_summary(5, "city"),
    "agg_cost_1m": _cost("1 minute"),
    "agg_cost_1h": _cost("1 hour"),
    "agg_cost_1d": _cost("1 day"),
    "agg_cost_1m_rounded": f"""
        select time_bucket(interval '1 minute', ts) as "timestamp", cast(user_id % 20 as integer) as "DID",
               'SN-' || (user_id % 20) as "DSN", ((sum(event_id % 2000) + 5) // 10)::double / 100 as total_cost
        from events group by all
    """,
    "agg_cost_fine": f"""
        select time_bucket(interval '1 hour', ts) as "timestamp", cast(user_id % 20 as integer) as "DID",
               'SN-' || (user_id % 20) as "DSN", sum(event_id % 1000 + 1)::double / 10000000 as total_cost
        from events group by all
    """,
    "agg_cost_grains": _GRAINS,
    "str_window_offset": _cost(
        "1 day", bucket="time_bucket(interval '{grain}', ts - interval '17 hours') + interval '17 hours'"
    ),
    "str_cost_1h_update": _cost("1 hour"),
    "str_meter_1m_update": _meter_summary(1, "id, city"),
    "str_raw_append": _METER_TEXT,
    "str_cost_1h_append": _cost("1 hour", where=_closed("1 hour", "1 hour")),
    "str_meter_5m_chained": _rollup(
        f"where w + interval '5 minutes' <= (select max(date_time) from ({METER}) m) - interval '1 minute'"
    ),
    "str_late_rows": _LATE,
    "str_fan_out": f"""
        select 'raw_device' as flow, count(*) as rows,
               cast(sum(cast(value as decimal(18,2))) as double) as total_cost from events
        union all {_flow("cost_1m", "1 minute")} union all {_flow("cost_1h", "1 hour")}
        union all {_flow("cost_1d", "1 day")}
    """,
    "str_cost_cascade": _CASCADE,
    "str_quarantine": f"select {_BAD} as status, count(*) as messages from events group by 1",
    "snk_summary_table": _cost("1 day"),
    "snk_replayed_batch": _cost("1 day"),
    "snk_raw_documents": _device(time=_SECOND),
    "snk_parquet_append": _METER_TIMED,
    "set_union_all": f"""
        select "DID", count(*) as rows, cast(sum("KPWR") as bigint) as total_kpwr
        from ({_DEVICE_TEXT} union all {_DEVICE_TEXT}) d group by 1
    """,
    "ra_city_lookup": f"select {_TEXT} as date_time, id, city from ({METER}) m",
    "ra_lamp_city": f'select "id_kWh", "timestamp", city from ({_LAMP}) l',
    "ra_out_of_band_lamp_rate": f"""
        select time_bucket(interval '1 hour', "timestamp") as "timestamp", city, count(*) as readings,
               count(*) filter (watt < 40 or watt > 70) as out_of_band,
               count(*) filter (watt < 40 or watt > 70) / count(*)::double as rate
        from ({_LAMP}) l group by 1, 2
    """,
    "ra_array_quarantine": """
        select 'malformed' as status, count(*) as messages, cast(0 as bigint) as with_id
        from events where event_id % 97 = 0 or event_id % 101 = 0
        union all
        select status, count(*), count(*) from events cross join (values ('ok'), ('bad_fields')) s(status)
        where event_id % 97 <> 0 and event_id % 101 <> 0 group by 1
    """,
    "ra_derived_current": f"""
        select date_time, id, city, p as "P (watt)", v as "V (volt)",
               (ic + drift) / 100.0::double as "I (amphere)", ic / 100.0::double as derived_amphere,
               abs((ic + drift) * v * 2 - 200 * p) <= v as consistent
        from (select *, case when (epoch(date_time)::bigint - 1704067200) // 2 % 7 = 0 then 3 else 0 end as drift
              from ({METER}) m) d
    """,
    "ra_out_of_band_rate": f"""
        select time_bucket(interval '5 minutes', date_time) as "timestamp", id, city, count(*) as readings,
               count(*) filter (p < 250 or p > 300) as out_of_band,
               count(*) filter (p < 250 or p > 300) / count(*)::double as rate
        from ({METER}) m group by 1, 2, 3
    """,
    "ra_out_of_band_lamp": f"""
        select "id_kWh", "timestamp", watt, watt < 40 or watt > 70 as out_of_band from ({_LAMP}) l
    """,
    "ra_dedup_readings": f"select distinct * from ({_METER_TIMED}) r",
    "ra_dedup_stream": f"""
        select distinct * from ({_METER_TIMED}) r
        where date_time <= (select max(date_time) from ({METER}) m) - interval '1 minute'
    """,
    "ra_latest_revision": _cost("1 hour", extra=", max(event_id % 3) as batch_id"),
    "ra_array_payload": _READING.format(time=_TEXT, source=ARRAY),
    "ra_quarantine": f"""
        select {_BAD} as status, count(*) as messages, count(*) filter ({_PARSED}) as with_id,
               count(*) filter ({_BAD} = 'ok') as with_power
        from events group by 1
    """,
    "ra_parse_lamp": _LAMP,
}

ORACLES["str_fan_out_landed"] = ORACLES["str_fan_out"]
ORACLES["snk_bucketed_summary"] = ORACLES["snk_summary_table"]
ORACLES["snk_state_read"] = ORACLES["agg_cost_1h"]
ORACLES["str_delta_grains"] = ORACLES["agg_cost_grains"]
ORACLES["snk_committed_batches"] = ORACLES["snk_summary_table"]
ORACLES["src_variant_landing"] = ORACLES["prj_parse_device_float"]
ORACLES["ra_dedup_immediate"] = ORACLES["ra_dedup_readings"]
ORACLES["str_late_side_output"] = f"""
    select *, 'on_time' as reason from ({_LATE}) o
    union all
    select *, 'late' as reason from ({_LATE.replace("where before is null or", "where not (before is null or").replace("group by all", ") group by all")}) l
"""
ORACLES["agg_cost_any_float"] = """
    select time_bucket(interval '1 hour', ts) as "timestamp", cast(user_id % 20 as integer) as "DID",
           'SN-' || (user_id % 20) as "DSN", sum(event_id % 7 + 1)::double * power(2.0::double, -100) as total_cost
    from events group by all
"""
ORACLES["snk_documents_once"] = f"select *, cast(2 as bigint) as copies from ({_device(time=_SECOND)}) d"
ORACLES["ra_city_stream"] = f"""
    select date_time, id, case when id = '5' and (epoch(date_time)::bigint - 1704067200) // 2 % 2 = 0 then null else city end as city
    from ({METER}) m
"""
ORACLES["str_landed_city"] = f"""
    select *, '1m' as grain from ({_meter_summary(1, "city")}) a
    union all select *, '5m' as grain from ({_meter_summary(5, "city")}) b
"""
_MIXED = """
    case when event_id % 97 = 0 or event_id % 101 = 0 then 'malformed' when event_id % 103 = 0 then 'no_elements'
         when event_id % 107 = 0 then 'no_object' when event_id % 109 = 0 then 'empty' end
"""
ORACLES["ra_variant_quarantine"] = f"""
    with sent as (select event_id, {_MIXED} as wrong from events)
    select status, count(*) as messages, count(*) filter (status in ('ok', 'bad_fields')) as with_id,
           count(*) filter (status = 'ok') as with_power
    from (select coalesce(wrong, 'ok') as status from sent
          union all select 'bad_fields' from sent where wrong is null and event_id % 2 = 1) s
    group by 1
"""
ORACLES["str_landed_checked"] = f"""
    with sent as (select *, {_MIXED} as wrong from events),
    hours as (select time_bucket(interval '1 hour', ts) as h, user_id % 20 as d, sum(cast(value as decimal(18,2))) as cost
              from sent where wrong is null group by 1, 2)
    select 'raw_checked' as flow, count(*) as rows, cast(sum(cast(value as decimal(18,2))) as double) as total_cost
    from sent where wrong is null
    union all select coalesce(wrong, 'bad_fields'), count(*), null from sent
              where wrong is not null or event_id % 2 = 1 group by 1
    union all select 'cost_1h', count(*), cast(sum(cost) as double) from hours
"""
