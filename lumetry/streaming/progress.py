"""What a stream says of its batches: how far its watermark is, and how many rows came too late for it."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Progress(NamedTuple):
    query: str
    batch_id: int
    watermark: str | None
    rows_in: int
    rows_dropped: int  # behind the watermark; of an aggregate, its partial sums
    rows_of_state: int


class ProgressLog(StreamingQueryListener):
    """Keeps the last batches' progress, and hands each on to `told`, which may write it where it is watched."""

    def __init__(self, told=None, most: int = 10_000):
        self.records: deque[Progress] = deque(maxlen=most)
        self.told = told

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        progress = json.loads(event.progress.json)
        states = progress.get("stateOperators", [])
        record = Progress(
            progress.get("name") or progress["id"],
            progress["batchId"],
            progress.get("eventTime", {}).get("watermark"),
            progress.get("numInputRows") or 0,
            sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
            sum(s.get("numRowsTotal", 0) for s in states),
        )
        self.records.append(record)
        if self.told:
            self.told(record)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


@contextmanager
def progress_log(spark: SparkSession, told=None) -> Iterator[ProgressLog]:
    """Listen to all streams of the session."""
    log = ProgressLog(told)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
