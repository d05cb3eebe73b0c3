"""Message sources. Each gives a DataFrame with one column, `value`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: Sequence[str], topic: str, starting: str = "latest", **options: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": topic,
        "startingOffsets": starting,
        **options,
    }


def kafka_messages(
    spark: SparkSession,
    servers: Sequence[str],
    topic: str,
    starting: str = "latest",
    stream: bool = True,
    position: bool = False,
    **options: str,
) -> DataFrame:
    """Messages of a Kafka topic, from the newest (`latest`) or the oldest (`earliest`) on.

    Useful at volume: `minPartitions` splits a topic partition that holds far more than the others over several
    tasks, and `maxOffsetsPerTrigger` bounds a micro-batch when a stream catches up. A batch read starts at
    `earliest`. `position` keeps topic, partition and offset, which tell messages apart. The connector
    (`spark-sql-kafka-0-10`) must be on the session's classpath.
    """
    if not stream and starting == "latest":
        raise ValueError("a batch read has nothing to read from 'latest'; use starting='earliest'")
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**kafka_options(servers, topic, starting, **options)).load().select(
        "value", *(("topic", "partition", "offset") if position else ())
    )


def socket_messages(spark: SparkSession, host: str = "localhost", port: int = 9999) -> DataFrame:
    """Lines of a TCP connection. One connection per query and no replay after a failure: for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def landed_messages(spark: SparkSession, path: str, stream: bool = True, **options: str) -> DataFrame:
    """Messages landed as text files, one per line. A stream reads the files that are there, then new ones.

    `maxBytesPerTrigger` or `maxFilesPerTrigger` bounds a micro-batch when a stream catches up. After the first batch
    Spark passes over files that are older than `maxFileAge`, seven days unless told otherwise; here that is ten years, so
    that archives copied with their old times are read.
    """
    reader = spark.readStream.option("maxFileAge", "3650d") if stream else spark.read
    return reader.options(**options).text(path)
