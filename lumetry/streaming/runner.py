"""Start streaming queries and wait for them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import Sink


POLL_SECONDS = 1  # between two looks at all queries


class Flow(NamedTuple):
    """One streaming query of a pipeline: what it emits, how, and how often."""

    name: str
    frame: DataFrame
    mode: str = "append"
    every: str | None = None


def start(flow: Flow, sink: Sink, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start a query. Its offsets and state live below `checkpoint`, under the flow's name.

    Without `every` a batch starts as soon as the last one is done. `available_now` reads what is there, in as many
    batches as the source's limits ask for, and ends.
    """
    writer = flow.frame.writeStream.queryName(flow.name).outputMode(flow.mode)
    writer = sink(writer).option("checkpointLocation", f"{checkpoint.rstrip('/')}/{flow.name}")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif flow.every:
        writer = writer.trigger(processingTime=flow.every)
    return writer.start()


def run_available(flows: Mapping[Flow, Sink], checkpoint: str) -> None:
    """Run flows side by side over what their sources hold now; the first failure is raised."""
    queries = [start(flow, sink, checkpoint, available_now=True) for flow, sink in flows.items()]
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def await_any(queries: list[StreamingQuery]) -> None:
    """Wait until one of these queries ends, stop the others, and raise its error if it failed.

    Queries of the session that ended before, or that somebody else runs, do not count.
    """
    try:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(POLL_SECONDS)
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
