"""Message topics. The connector is not part of every install; file streams stand in.

All readers return one ``value STRING`` column, so either form feeds the same pipeline.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return decode_values(reader.load())


def decode_values(messages: DataFrame) -> DataFrame:
    """Raw message bytes as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def encode_messages(lines: DataFrame, separator: str = r"\|") -> DataFrame:
    """Key and value bytes; the key is the user id, so one user stays in order."""
    return lines.select(
        F.get(F.split("value", separator), F.lit(0)).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
    )


def write_topic(lines: DataFrame, servers: str, topic: str, checkpoint: str):
    return (
        encode_messages(lines)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "1")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
