"""Left join of a per-key summary onto every record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattgrade.functions.scalars import pad_code
from wattgrade.session import staged


def attach_commune_mean(
    records: DataFrame, code: str, means: DataFrame, means_code: str, stage: bool = True
) -> DataFrame:
    """Every record with its commune's mean; records without one keep a null.

    The summary has one row per commune, a number nobody guarantees, so there is no broadcast hint. It is written
    to the shared folder first and read back: Spark then knows its true size, broadcasts it while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and the records are never shuffled. Above that it becomes a sort-merge
    join in which adaptive execution splits a commune that holds a large share of the records.
    """
    summary = staged(means, "commune-means") if stage else means
    summary = summary.withColumnRenamed(means_code, "_code")
    padded = records.withColumn(code, pad_code(F.col(code)))
    return padded.join(summary, F.col(code) == F.col("_code"), "left").drop("_code")
