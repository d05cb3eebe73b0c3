"""Summary tables in a relational database."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .tables import Sink

# Text columns that a database can index, instead of the unbounded text Spark would choose.
TEXT_COLUMNS = {"id": "VARCHAR(255)", "city": "VARCHAR(255)", "DSN": "VARCHAR(255)"}


def jdbc_options(
    url: str, table: str, columns: Sequence[str] = (), connections: int = 8, **options: str
) -> dict[str, str]:
    """Options of the JDBC writer: large insert batches over a bounded number of connections."""
    chosen = {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": "10000",
        "isolationLevel": "READ_COMMITTED",
    }
    types = [f"{name} {TEXT_COLUMNS[name]}" for name in columns if name in TEXT_COLUMNS]
    if types:
        chosen["createTableColumnTypes"] = ", ".join(types)
    return {**chosen, **options}


def jdbc_rows(batch: DataFrame, batch_id: int, run_id: int = 0) -> DataFrame:
    """Summary rows as they go into a table: with `batch_id` and `run_id`, and the window start as a zone-less date and time."""
    return batch.withColumns(
        {
            "timestamp": F.col("timestamp").cast("timestamp_ntz"),
            "batch_id": F.lit(batch_id).cast("bigint"),
            "run_id": F.lit(run_id).cast("bigint"),
        }
    )


def jdbc_revisions(url: str, table: str, connections: int = 8, **options: str) -> Sink:
    """Append what each batch changed, with its `batch_id` and the `run_id` of this start. The first batch creates the table.

    The executors insert; nothing passes through the driver. The batch is dealt out anew for the connections, or the
    writer would have the whole aggregate run in as few tasks. Spark commits per task, so a batch that fails halfway
    leaves rows which its second run repeats; a new checkpoint counts batches from 0, in a later run. So read the table
    through `latest_revision`, which puts runs before batches.
    """
    run_id = int(time.time())

    def write(batch: DataFrame, batch_id: int) -> None:
        chosen = jdbc_options(url, table, batch.columns, connections, **options)
        jdbc_rows(batch, batch_id, run_id).repartition(connections).write.format("jdbc").options(**chosen).mode("append").save()

    def setup(writer: DataStreamWriter) -> DataStreamWriter:
        return writer.foreachBatch(write)

    return setup
