"""A look-up on a stream, in a table that changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.lookup import with_city
from .commits import Staged, committed
from .tables import Sink


def looked_up(path: str, cities: Callable[[SparkSession], DataFrame], key: str = "id", other: str = "id") -> Sink:
    """Commit readings with the columns of a city table as it is when their batch is written.

    A stream that joins a table of files keeps the files that were there when it started; here `cities` reads the table
    anew for each batch. A batch that is run again sees the table as it is then.
    """

    def stage(batch: DataFrame, staged: Staged) -> None:
        with_city(batch, cities(batch.sparkSession), key, other).write.parquet(staged.table("readings"))

    return committed(path, stage)
