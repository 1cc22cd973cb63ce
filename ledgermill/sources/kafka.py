"""Event topic source and sink, with a file stream of the same shape.

Both readers return one binary ``value`` column per event. The Kafka connector
is a separate Spark package the cluster supplies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DEFAULT_TOPIC = "bank.transactions.v1"


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str = DEFAULT_TOPIC,
    starting: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("value")


def read_json_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of JSON-lines files as a stream of ``value``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(F.col("value").cast("binary").alias("value"))


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as a JSON ``value``, with an optional message key."""
    value = F.to_json(F.struct("*")).cast("binary").alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value)


def write_topic(
    messages: DataFrame, servers: str, checkpoint: str, topic: str = DEFAULT_TOPIC
) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
