import json

import pytest

from lumetry.operators import latest_revision
from lumetry.schemas import COST_SUMMARY
from lumetry.session import shared_folder
from lumetry.sinks import (
    compact,
    create_if_missing,
    document_store,
    documents,
    folded,
    jdbc_options,
    jdbc_revisions,
    read_revisions,
    revisions,
)
from lumetry.sources import empty_table, kafka_messages, kafka_options, landed_messages, read_json, socket_messages, table_of
from lumetry.sinks.jdbc import jdbc_rows
from lumetry.streaming import Flow, run_available


class Writer:
    """Stands in for a DataStreamWriter and keeps the batch function."""

    def foreachBatch(self, write):
        self.write = write
        return self


def summary(spark, *rows):
    return spark.createDataFrame(rows, "timestamp STRING, DID INT, DSN STRING, total_cost DOUBLE").selectExpr(
        "cast(timestamp as timestamp) as timestamp", "DID", "DSN", "total_cost"
    )


def test_a_batch_written_twice_counts_once(spark):
    table = shared_folder(spark)
    write = revisions(table)(Writer()).write
    write(summary(spark, ("2024-01-01", 1, "a", 1.0), ("2024-01-01", 2, "b", 5.0)), 0)
    for _ in range(2):
        write(summary(spark, ("2024-01-01", 1, "a", 3.0)), 1)
    assert read_revisions(spark, table, COST_SUMMARY).count() == 3
    compacted = compact(spark, table, shared_folder(spark), COST_SUMMARY, ("timestamp", "DID", "DSN"))
    assert sorted((r["DID"], r["total_cost"], r["batch_id"]) for r in compacted.collect()) == [(1, 3.0, 1), (2, 5.0, 0)]


def test_closed_days_are_settled_once(spark):
    table, target, keys = shared_folder(spark), shared_folder(spark), ("timestamp", "DID", "DSN")
    write = revisions(table)(Writer()).write
    write(summary(spark, ("2024-01-01", 1, "a", 1.0), ("2024-01-02", 1, "a", 5.0)), 0)
    first = compact(spark, table, target, COST_SUMMARY, keys, ("2024-01-01", "2024-01-01"))
    assert [r["total_cost"] for r in first.collect()] == [1.0]
    write(summary(spark, ("2024-01-01", 1, "a", 2.0), ("2024-01-02", 1, "a", 6.0)), 1)
    both = compact(spark, table, target, COST_SUMMARY, keys, ("2024-01-02", "2024-01-02"))
    assert sorted(r["total_cost"] for r in both.collect()) == [1.0, 6.0]
    plan = read_revisions(spark, table, COST_SUMMARY, ("2024-01-02", "2024-01-02"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_create_if_missing_leaves_a_table_alone(spark):
    table = shared_folder(spark)
    create_if_missing(spark, table, COST_SUMMARY)
    assert spark.read.parquet(table).count() == 0
    summary(spark, ("2024-01-01", 1, "a", 1.0)).write.mode("append").parquet(table)
    create_if_missing(spark, table, COST_SUMMARY)
    assert spark.read.parquet(table).count() == 1


def test_documents_are_one_json_object_per_row(spark):
    folder = shared_folder(spark)
    create_if_missing(spark, f"{folder}/landing", "value STRING", "text")
    spark.createDataFrame([("a",), ("b",)], "value STRING").write.mode("append").text(f"{folder}/landing")
    frame = landed_messages(spark, f"{folder}/landing").selectExpr("value", "length(value) as size")
    run_available({Flow("raw", frame): documents(f"{folder}/raw", ["size"])}, f"{folder}/checkpoint")
    lines = spark.read.text(f"{folder}/raw").select("value").collect()
    assert sorted(json.loads(r[0])["value"] for r in lines) == ["a", "b"]


def test_document_store_appends_through_its_connector(spark):
    folder = shared_folder(spark)
    write = document_store("json", path=folder)(Writer()).write
    for batch_id in range(2):
        write(summary(spark, ("2024-01-01", 1, "a", 1.0)), batch_id)
    assert spark.read.json(folder).count() == 2


def test_a_document_written_twice_has_one_id(spark):
    folder = shared_folder(spark)
    rows = spark.createDataFrame([("t", 0, 7, "a"), ("t", 1, 7, "a")], "topic STRING, partition INT, offset LONG, v STRING")
    write = document_store("json", ("topic", "partition", "offset"), path=folder)(Writer()).write
    for batch_id in range(2):
        write(rows, batch_id)
    stored = spark.read.json(folder)
    assert stored.columns == ["_id", "v"] and sorted(r["_id"] for r in stored.distinct().collect()) == ["t/0/7", "t/1/7"]


def test_a_later_run_goes_before_a_later_batch(spark):
    stored = [("k", 90.0, 9, 1_700_000_000), ("k", 120.0, 0, 1_700_000_500)]
    table = spark.createDataFrame(stored, "k STRING, v DOUBLE, batch_id LONG, run_id LONG")
    (row,) = latest_revision(table, ["k"]).collect()
    assert (row["v"], row["batch_id"]) == (120.0, 0)


def test_a_few_connections_do_not_slow_the_aggregate(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.save", lambda self: seen.append(self._df.rdd.getNumPartitions()))
    jdbc_revisions("jdbc:x", "t", connections=3)(Writer()).write(summary(spark, ("2024-01-01", 1, "a", 1.0)).repartition(7), 0)
    assert seen == [3]


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "summary_1m", ["timestamp", "DID", "DSN"], connections=4, driver="d", batchsize="5")
    assert options == {
        "url": "jdbc:x",
        "dbtable": "summary_1m",
        "numPartitions": "4",
        "batchsize": "5",
        "isolationLevel": "READ_COMMITTED",
        "createTableColumnTypes": "DSN VARCHAR(255)",
        "driver": "d",
    }


def test_jdbc_rows_carry_their_batch_and_a_zoneless_time(spark):
    rows = jdbc_rows(summary(spark, ("2024-01-01", 1, "a", 1.0)), 7)
    kinds = dict(rows.dtypes)
    assert (kinds["timestamp"], kinds["batch_id"], rows.first()["batch_id"]) == ("timestamp_ntz", "bigint", 7)
    as_text = spark.createDataFrame([("2024-01-01 00:05:00", "a", 1)], "timestamp STRING, city STRING, total_watt BIGINT")
    assert jdbc_rows(as_text, 0).first()["timestamp"].minute == 5


def test_jdbc_failures_are_not_swallowed(spark):
    write = jdbc_revisions("jdbc:none:nowhere", "t")(Writer()).write
    with pytest.raises(Exception, match="(?i)driver"):
        write(summary(spark, ("2024-01-01", 1, "a", 1.0)), 0)


def test_kafka_options():
    assert kafka_options(["a:1", "b:2"], "t", "earliest", minPartitions="64") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "minPartitions": "64",
    }


def test_a_batch_read_of_kafka_cannot_start_at_the_end(spark):
    with pytest.raises(ValueError, match="earliest"):
        kafka_messages(spark, ["a:1"], "t", stream=False)


def test_socket_lines_are_a_stream_of_values(spark):
    lines = socket_messages(spark, "localhost", 9999)  # connects only when a query starts
    assert lines.isStreaming and lines.columns == ["value"]


def test_tables_with_a_schema(spark):
    assert empty_table(spark, "a INT, b STRING").dtypes == [("a", "int"), ("b", "string")]
    rows = table_of(spark, [{"a": 1, "b": "x"}, {"a": 2}], "a INT, b STRING")
    assert [tuple(r) for r in rows.collect()] == [(1, "x"), (2, None)]


def test_json_files_with_a_declared_schema(spark):
    folder = shared_folder(spark)
    texts = ['{"a":1,"z":2}', "no", "", '{"a":"x","b":"y"}', '[{"a":2},{"a":3}]']
    spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1).write.text(folder)
    rows = [tuple(r) for r in read_json(spark, folder, "a INT, b STRING").collect()]
    assert rows == [(1, None), (None, None), (None, "y"), (2, None), (3, None)]


def test_documents_are_told_apart_by_content_and_batch(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("a", None, 1), (None, 1, 1)], "s STRING, n INT, m INT")
    first = {(r["s"], r["n"], r["m"]): (r["_id"], r["copies"]) for r in folded(rows, 3).collect()}
    again = {(r["s"], r["n"], r["m"]): (r["_id"], r["copies"]) for r in folded(rows.repartition(5), 3).collect()}
    assert first == again and first["a", 1, None][1] == 2 and len({i for i, _ in first.values()}) == 3
    assert {i.split("/")[0] for i, _ in first.values()} == {"3"}
    target = shared_folder(spark)
    write = document_store("json", once=True, path=target)(Writer()).write
    for _ in range(2):
        write(rows, 0)
    assert spark.read.json(target).select("_id").distinct().count() == 3
