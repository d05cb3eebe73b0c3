import pytest

from checks import payloads as P
from lumetry.__main__ import arguments, main, sink_of
from lumetry.session import shared_folder
from lumetry.sinks import read_delta_grains
from lumetry.streaming import Flow


def test_kafka_needs_a_topic(capsys):
    with pytest.raises(SystemExit):
        arguments(["city", "--kafka", "a:1", "--checkpoint", "x"])
    assert "--topic" in capsys.readouterr().err


def test_a_checkpoint_is_required():
    with pytest.raises(SystemExit):
        arguments(["city", "--socket", "a:1"])


def test_run_over_landed_files(spark):
    folder = shared_folder(spark)
    P.meter(P.events(spark, "/root/testdata/sf0.001")).write.text(f"{folder}/landing")
    where = ["--files", f"{folder}/landing", "--table", f"{folder}/tables", "--checkpoint", f"{folder}/checkpoint"]
    main(["city", *where, "--available-now"])
    main(["raw_meter", *where, "--available-now", "--source-option", "maxFilesPerTrigger=1"])
    assert spark.read.parquet(f"{folder}/tables/city_5m/revisions").select("batch_id").distinct().count() == 1
    assert spark.read.json(f"{folder}/tables/raw_meter").count() == 1000


def test_summaries_go_to_the_database_and_raw_readings_to_files():
    chosen = arguments(["raw_and_cost", "--socket", "a:1", "--checkpoint", "c", "--jdbc", "jdbc:x", "--table", "t"])
    assert "jdbc" in sink_of(Flow("cost_1m", None, "update"), chosen).__qualname__
    assert "_files" in sink_of(Flow("raw_device", None), chosen).__qualname__


def test_raw_readings_can_go_to_a_document_store():
    connector = ["--raw-connector", "mongodb", "--raw-option", "connection.uri=mongodb://h/?a=b"]
    chosen = arguments(["raw_and_cost", "--socket", "a:1", "--checkpoint", "c", *connector])
    assert "document_store" in sink_of(Flow("raw_device", None), chosen).__qualname__
    with pytest.raises(SystemExit, match="no sink"):
        sink_of(Flow("cost_1m", None, "update"), chosen)
    chosen = arguments(["raw_and_cost", "--socket", "a:1", "--checkpoint", "c", *connector, "--console"])
    assert "console" in sink_of(Flow("cost_1m", None, "update"), chosen).__qualname__


def test_grains_read_what_was_landed(spark):
    folder = shared_folder(spark)
    P.device(P.events(spark, "/root/testdata/sf0.001")).write.text(f"{folder}/landing")
    where = ["--files", f"{folder}/landing", "--table", f"{folder}/tables", "--checkpoint", f"{folder}/checkpoint"]
    main(["landed_costs", *where, "--available-now"])
    assert spark.read.parquet(f"{folder}/tables/raw_device").count() == 1000
    assert spark.read.parquet(f"{folder}/tables/cost_1d/revisions").select("batch_id").distinct().count() == 1


def test_landed_costs_need_a_table(capsys):
    with pytest.raises(SystemExit):
        arguments(["landed_costs", "--socket", "a:1", "--checkpoint", "c"])
    assert "--table" in capsys.readouterr().err


@pytest.mark.parametrize("other", [["--jdbc", "jdbc:x"], ["--console"], ["--raw-connector", "mongodb"]])
@pytest.mark.parametrize("pipeline", ["landed_costs", "landed_checked", "cost_deltas"])
def test_pipelines_that_land_tables_refuse_other_sinks(capsys, pipeline, other):
    with pytest.raises(SystemExit):
        arguments([pipeline, "--socket", "a:1", "--checkpoint", "c", "--table", "t", *other])
    assert "tables only" in capsys.readouterr().err


def test_compaction_by_command(spark):
    folder = shared_folder(spark)
    P.device(P.events(spark, "/root/testdata/sf0.001")).write.text(f"{folder}/landing")
    where = ["--files", f"{folder}/landing", "--table", f"{folder}/tables", "--checkpoint", f"{folder}/checkpoint"]
    main(["landed_costs", *where, "--available-now"])
    ask = ["compact", "--table", f"{folder}/tables/cost_1d", "--target", f"{folder}/summary", "--rows", "cost"]
    main([*ask, "--days", "2024-01-05", "2024-01-05"])
    one = spark.read.parquet(f"{folder}/summary")
    assert [str(r["day"]) for r in one.select("day").distinct().collect()] == ["2024-01-05"]
    main(ask)
    everything = spark.read.parquet(f"{folder}/summary")
    assert everything.select("day").distinct().count() > 20
    assert everything.count() == everything.select("timestamp", "DID", "DSN").distinct().count()


def test_deltas_by_command(spark):
    folder = shared_folder(spark)
    P.device(P.events(spark, "/root/testdata/sf0.001")).write.text(f"{folder}/landing")
    where = ["--files", f"{folder}/landing", "--table", f"{folder}/tables", "--checkpoint", f"{folder}/checkpoint"]
    for _ in range(2):
        main(["cost_deltas", *where, "--available-now"])
    grains = read_delta_grains(spark, f"{folder}/tables/cost_deltas")
    assert {r["grain"] for r in grains.select("grain").distinct().collect()} == {"1m", "1h", "1d"}
    assert spark.read.parquet(f"{folder}/tables/cost_deltas/readings").count() == 1000
