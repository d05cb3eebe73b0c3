"""What a stream holds in its state, read as a table by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import COST
from ..operators.summaries import BY_DEVICE, cost_report

# The buffers of the sums of COST, in the order of the aggregate: Spark names them all alike.
BUFFERS = "STRUCT<hundredths: BIGINT, sum: DECIMAL(28,6), no_sum: BOOLEAN, fine: DECIMAL(34,18), no_fine: BOOLEAN, rest: DOUBLE>"


def cost_state(spark: SparkSession, checkpoint: str, flow: str) -> DataFrame:
    """Cost per window as a flow of `cost_summary` holds it after its last batch, read from its checkpoint.

    With output mode `complete`, or without a watermark, that is the whole accumulated table; with one, the windows that
    are still open. The stream needs no sink for it, and nothing passes through the driver.
    """
    state = spark.read.format("statestore").load(f"{checkpoint.rstrip('/')}/{flow}")
    rows = state.select(F.col("key.window").alias("w"), *(F.col(f"key.{c}") for c in BY_DEVICE), F.col("value").cast(BUFFERS).alias("v"))
    parts = {
        "hundredths": F.col("v.hundredths"),
        "sum": F.when(~F.col("v.no_sum"), F.col("v.sum")),
        "fine": F.when(~F.col("v.no_fine"), F.col("v.fine")),
        "rest": F.col("v.rest"),
    }
    return cost_report(rows.select("w", *BY_DEVICE, *(value.alias(f"{COST.name}_{part}") for part, value in parts.items())))
