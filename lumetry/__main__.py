"""Run a pipeline: `python -m lumetry meter_5m --kafka host:9092 --topic meters --checkpoint <shared folder>`.

`python -m lumetry compact --table <revisions> --target <summary> --rows cost --days 2024-01-01 2024-01-07` settles the
revisions that the summaries' flows leave behind.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .operators.summaries import BY_CITY, BY_DEVICE, BY_METER
from .plans import COMMITTED, LANDED, PIPELINES
from .schemas import CITY_SUMMARY, COST_SUMMARY, METER_SUMMARY
from .session import build_session
from .sinks import compact, console, document_store, documents, jdbc_revisions, parquet, revisions
from .sinks.tables import Sink
from .sources import kafka_messages, landed_messages, socket_messages
from .streaming import Flow, await_any, run_available, start

# What `compact` knows: the columns of a summary and those of its keys.
SUMMARIES = {
    "cost": (COST_SUMMARY, ("timestamp", *BY_DEVICE)),
    "meter": (METER_SUMMARY, ("timestamp", *BY_METER)),
    "city": (CITY_SUMMARY, ("timestamp", *BY_CITY)),
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lumetry", description="Telemetry summaries on Spark")
    parser.add_argument("pipeline", choices=sorted([*PIPELINES, *LANDED, *COMMITTED]))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="HOST:PORT[,...]")
    source.add_argument("--socket", metavar="HOST:PORT")
    source.add_argument("--files", metavar="FOLDER", help="text files with one message per line")
    parser.add_argument("--topic", help="Kafka topic")
    source_help = "for the source, e.g. minPartitions, maxOffsetsPerTrigger, maxBytesPerTrigger, kafka.security.protocol"
    parser.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE", help=source_help)
    parser.add_argument("--starting", choices=["latest", "earliest"], default="latest")
    parser.add_argument("--table", metavar="FOLDER", help="write tables below this folder")
    parser.add_argument("--jdbc", metavar="URL", help="write summaries to tables named after their flow")
    parser.add_argument("--driver", help="JDBC driver class")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE", help="for the JDBC writer")
    parser.add_argument("--console", action="store_true", help="show what has no other sink; for trials")
    parser.add_argument("--raw-connector", help="write raw readings through a document-store connector, e.g. mongodb")
    parser.add_argument("--raw-option", action="append", default=[], metavar="KEY=VALUE", help="for that connector")
    parser.add_argument("--checkpoint", required=True, help="folder that all executors share")
    parser.add_argument("--every", help="time between batches instead of the pipeline's own")
    parser.add_argument("--available-now", action="store_true", help="read what is there and end")
    parsed = parser.parse_args(argv)
    if parsed.kafka and not parsed.topic:
        parser.error("--kafka needs --topic")
    if parsed.pipeline not in PIPELINES:
        if not parsed.table:
            parser.error(f"{parsed.pipeline} needs --table")
        if parsed.jdbc or parsed.console or parsed.raw_connector:
            parser.error(f"{parsed.pipeline} writes tables only, below --table")
    return parsed


def compact_arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lumetry compact", description="The latest revision of every window")
    parser.add_argument("--table", required=True, metavar="FOLDER", help="revisions, as a summary's flow writes them")
    parser.add_argument("--target", required=True, metavar="FOLDER", help="the summary, in folders per day")
    parser.add_argument("--rows", choices=sorted(SUMMARIES), required=True)
    parser.add_argument("--days", nargs=2, metavar=("FIRST", "LAST"), help="settle these days only, and leave the others")
    return parser.parse_args(argv)


def _options(given: list[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in given)


def messages_of(spark: SparkSession, chosen: argparse.Namespace) -> DataFrame:
    options = _options(chosen.source_option)
    if chosen.kafka:
        # A store that writes by id needs to know one message from another.
        position = bool(chosen.raw_connector)
        return kafka_messages(spark, chosen.kafka.split(","), chosen.topic, chosen.starting, position=position, **options)
    if chosen.socket:
        host, port = chosen.socket.rsplit(":", 1)
        return socket_messages(spark, host, int(port))
    return landed_messages(spark, chosen.files, **options)


def sink_of(flow: Flow, chosen: argparse.Namespace) -> Sink:
    raw = flow.name.startswith("raw")
    if chosen.raw_connector and raw:
        key = [c for c in ("topic", "partition", "offset") if flow.frame is not None and c in flow.frame.columns]
        return document_store(chosen.raw_connector, key, once=not key, **_options(chosen.raw_option))
    if chosen.jdbc and not raw:
        options = {"driver": chosen.driver} if chosen.driver else {}
        return jdbc_revisions(chosen.jdbc, flow.name, **options, **_options(chosen.jdbc_option))
    if chosen.table:
        path = f"{chosen.table.rstrip('/')}/{flow.name}"
        if flow.mode == "update":
            return revisions(path)
        return documents(path) if raw else parquet(path)
    if chosen.console:
        return console()
    raise SystemExit(f"{flow.name} has no sink: give --table, --jdbc or --raw-connector, or --console to look at it")


def main(argv: list[str] | None = None) -> None:
    given = sys.argv[1:] if argv is None else argv
    if given[:1] == ["compact"]:
        asked = compact_arguments(given[1:])
        schema, keys = SUMMARIES[asked.rows]
        compact(build_session("lumetry"), asked.table, asked.target, schema, keys, asked.days and tuple(asked.days))
        return
    chosen = arguments(given)
    spark = build_session("lumetry")
    # Pipelines share names of flows, so each has a folder of its own below the checkpoint.
    checkpoint = f"{chosen.checkpoint.rstrip('/')}/{chosen.pipeline}"
    messages = messages_of(spark, chosen)
    if chosen.pipeline in LANDED:
        pairs = LANDED[chosen.pipeline](spark, messages, chosen.table.rstrip("/"))
    elif chosen.pipeline in COMMITTED:
        pairs = COMMITTED[chosen.pipeline](messages, chosen.table.rstrip("/"))
    else:
        pairs = [(flow, sink_of(flow, chosen)) for flow in PIPELINES[chosen.pipeline](messages)]
    flows = {flow._replace(every=chosen.every or flow.every): sink for flow, sink in pairs}
    if chosen.available_now and chosen.pipeline in LANDED:
        for flow, sink in flows.items():  # a flow reads what one before it landed
            run_available({flow: sink}, checkpoint)
    elif chosen.available_now:
        run_available(flows, checkpoint)
    else:
        await_any([start(flow, sink, checkpoint) for flow, sink in flows.items()])


if __name__ == "__main__":
    main()
