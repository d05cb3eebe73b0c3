"""Summary tables that keep every revision of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_revision(
    table: DataFrame, keys: Sequence[str], revision: str = "batch_id", run: str = "run_id"
) -> DataFrame:
    """The last revision of each key, and once only where a batch was written twice.

    Where the table says in which run a batch was written (a number, or the seconds since 1970 of a start), a later run
    goes before a later batch: a new checkpoint counts batches from 0 again.

    `max_by` folds the revisions within each task before the shuffle; ranking them would sort every one of a key's
    revisions in a single task.
    """
    # One number orders both, so that the aggregate stays a hash aggregate.
    order = F.col(revision)
    if run in table.columns:
        order = F.coalesce(F.col(run), F.lit(0)) * (1 << 31) + order
    values = [c for c in table.columns if c not in (*keys, revision)]
    return table.groupBy(*keys).agg(
        *(F.max_by(c, order).alias(c) for c in values), F.max_by(revision, order).alias(revision)
    )
