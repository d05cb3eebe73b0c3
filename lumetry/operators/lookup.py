"""Look up what a code stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_city(readings: DataFrame, cities: DataFrame, key: str = "id", other: str = "id") -> DataFrame:
    """Readings with the columns of a city table that has one row per `other`, matched by the readings' `key`.

    A reading with an unknown key stays, with NULLs. A plain join: Spark sends a table that is small by its statistics
    to the readings, and splits the readings of a busy key where it shuffles both.
    """
    known = cities.withColumnRenamed(other, "_key")
    return readings.join(known, readings[key] == known["_key"], "left").drop("_key")


def lamp_cities(cities: DataFrame) -> DataFrame:
    """One row per meter from a table with one row per city and an array of its `meters`."""
    return cities.select(F.explode("meters").alias("id_kWh"), "city")
