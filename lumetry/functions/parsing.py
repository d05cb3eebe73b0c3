"""Messages to typed readings. Narrow operations only: nothing here shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEVICE_COST, DEVICE_FLOAT, LAMP, METER


def payload_text(messages: DataFrame) -> DataFrame:
    """The message body as text, whatever the transport delivered (bytes or a line)."""
    return messages.select(F.col("value").cast("string").alias("value"))


def position(messages: DataFrame) -> list[str]:
    """The columns that tell messages apart, where the source kept them."""
    return [c for c in ("topic", "partition", "offset") if c in messages.columns]


def nonempty(messages: DataFrame) -> DataFrame:
    """Skip messages without a body."""
    return messages.where(F.col("value").isNotNull() & (F.length("value") > 0))


def elements(messages: DataFrame) -> DataFrame:
    """A message per element of messages that hold a JSON array; every other message, good or bad, stays as it is.

    Give these to `parse` or `with_parse_status`: no message disappears but an array without elements.
    """
    text = F.col("value").cast("string")
    parts = F.from_json(text, "ARRAY<STRING>")
    array = F.startswith(F.ltrim(text), F.lit("[")) & parts.isNotNull()
    return messages.select(F.explode(F.when(array, parts).otherwise(F.array(text))).alias("value"))


def parse(messages: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """One flat row per message. Text that is no JSON gives a row of NULLs, a field of the wrong type a NULL.

    The struct passes through `inline` because a filter on parsed fields would otherwise be pushed below the
    projection and parse every message a second time. Declare only the fields that are used: others are skipped.
    Columns of the messages named in `keep`, such as their offsets, come along.
    """
    text = F.col("value").cast("string")
    return messages.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def parse_array(messages: DataFrame, schema: str) -> DataFrame:
    """One row per element of messages that hold a JSON array; a single object counts as an array of one.

    A message that is neither gives a row of NULLs, as with `parse`, and so does an array without elements.
    """
    text = F.col("value").cast("string")
    return messages.select(F.inline_outer(F.from_json(text, f"ARRAY<STRUCT<{schema}>>")))


def event_time(text: Column | str) -> Column:
    """Text to timestamp; NULL where it is none, also under ANSI rules."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def timed(readings: DataFrame, column: str) -> DataFrame:
    """Readings with their text time as event time."""
    return readings.withColumn(column, event_time(column))


def meter_readings(messages: DataFrame) -> DataFrame:
    return timed(parse(messages, METER), "date_time")


def device_readings(messages: DataFrame, schema: str = DEVICE_FLOAT, keep: Sequence[str] = ()) -> DataFrame:
    """Device readings. The default schema reads whole and broken power figures alike."""
    return timed(parse(messages, schema, keep), "STIME")


def device_costs(messages: DataFrame) -> DataFrame:
    """The four columns of device readings that cost summaries use."""
    return timed(parse(messages, DEVICE_COST), "STIME")


def lamp_readings(messages: DataFrame) -> DataFrame:
    return timed(parse(messages, LAMP), "timestamp")


def with_cost_default(readings: DataFrame) -> DataFrame:
    """A reading without a cost costs nothing."""
    return readings.withColumn("COST", F.coalesce("COST", F.lit(0.0)).cast("float"))


def to_document(rows: DataFrame) -> DataFrame:
    """Each row as one JSON document."""
    return rows.select(F.to_json(F.struct("*")).alias("document"))


def with_parse_status(messages: DataFrame, schema: str) -> DataFrame:
    """The parsed fields plus the message and its status, so that good and bad messages can go separate ways.

    Status is `ok`, `empty`, `malformed` (no JSON) or `bad_fields` (JSON that does not fit the schema; the
    fields that do fit are kept). The text is looked at a second time only where the first pass complained.
    """
    text = F.col("value").cast("string")
    data = F.from_json(text, f"{schema}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    parsed = messages.select(text.alias("value"), F.inline(F.array(data)))
    fields = [f"`{c}`" for c in parsed.columns if c not in ("value", "_bad")]
    status = (
        F.when(F.col("value").isNull() | (F.trim("value") == ""), "empty")
        .when(F.col("_bad").isNull(), "ok")
        .when(F.try_parse_json("value").isNull(), "malformed")
        .otherwise("bad_fields")
    )
    return parsed.select("value", status.alias("status"), *fields)
