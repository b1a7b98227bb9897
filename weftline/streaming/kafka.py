"""Kafka as source and sink.  The connector is a separate package of the Spark distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Streaming DataFrame of one topic's messages."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    return reader.options(**options).load()


def topic_writer(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str = "30 seconds"
) -> DataStreamWriter:
    """Writer that sends changed rows to a topic; call ``start()`` on it."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(processingTime=every)
    )
