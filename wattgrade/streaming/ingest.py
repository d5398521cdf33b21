"""Structured Streaming from a feed to bronze and silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from wattgrade.operators.quality import row_rules
from wattgrade.roles import GRADES, GradeScale, Roles


def file_feed(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """New files under a path as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run_to_end(writer: DataStreamWriter) -> None:
    """Process what is there, in as many micro-batches as the source's limits make, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def land(
    records: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    by: Sequence[str] = (),
    per_file: int = 0,
) -> DataStreamWriter:
    """Append-only landing with the file sink: each record is written once, also after a restart."""
    writer = (
        records.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", per_file)
    )
    return writer.partitionBy(*by) if by else writer


def land_numbered(records: DataFrame, base: str, checkpoint: str, per_file: int = 0) -> DataStreamWriter:
    """One numbered directory of JSON lines per micro-batch.

    A batch that is replayed after a failure overwrites its own directory; numbers continue after a restart.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("maxRecordsPerFile", per_file).json(f"{base}/batch={batch_id}")

    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)


def silver_stream(records: DataFrame, roles: Roles, scale: GradeScale = GRADES) -> DataFrame:
    """The stateless clean on every micro-batch."""
    return row_rules(records, roles, scale)


def first_seen(records: DataFrame, key: Sequence[str], time: str, delay: str, salts: int = 8) -> DataFrame:
    """First record per key; state is dropped once the watermark has passed a key's time by ``delay``.

    With ``salts``, copies of a key are first reduced within that many groups of input partitions, so a key that
    makes up a large share of the feed does not meet in one task. Times without a zone are read as session time,
    because the watermark needs a zoned timestamp.
    """
    timed = records.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    if salts > 1:
        salted = timed.withColumn("_salt", F.spark_partition_id() % salts)
        timed = salted.dropDuplicatesWithinWatermark([*key, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark(list(key))
