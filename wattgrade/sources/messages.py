"""Message topics: options for the broker connector and the encoding on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from wattgrade.functions.scalars import decode_message, encode_message


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """A topic as a stream; needs the Kafka connector on the cluster. The checkpoint of the query keeps offsets."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def encode_rows(df: DataFrame) -> DataFrame:
    """Each row as one UTF-8 JSON message in a ``value`` column."""
    return df.select(encode_message(*[F.col(f"`{c}`") for c in df.columns]).alias("value"))


def decode_rows(messages: DataFrame, schema: T.StructType, corrupt_column: str | None = None) -> DataFrame:
    """Message values as records. With ``corrupt_column``, a malformed message is a row holding its text there."""
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    return messages.select(decode_message(F.col("value"), schema, corrupt_column).alias("_m")).select("_m.*")


def send_rows(df: DataFrame, servers: str, topic: str) -> None:
    """Batch send of every row to a topic."""
    encode_rows(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def send_stream(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Streaming send; the checkpoint resumes after a restart."""
    writer = encode_rows(df).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint)
