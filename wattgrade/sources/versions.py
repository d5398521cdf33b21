"""Tables in versioned folders with a log that says which one readers see."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrade.sources import writers

LOG = "_versions"
LOG_SCHEMA = "number long, folder string, written timestamp"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(number, folder, written) of every version written whole; no rows where there is none. One row per write."""
    try:
        return spark.read.schema(LOG_SCHEMA).json(f"{path}/{LOG}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the newest version; the path itself for a table without versions."""
    newest = versions(spark, path).orderBy(F.desc("number"), F.desc("folder")).first()
    return f"{path}/{newest['folder']}" if newest else path


def publish(df: DataFrame, path: str, by: Sequence[str] = ()) -> str:
    """Writes ``df`` beside the versions that are there and names it in the log once it is whole; returns its folder.

    Until then, and if the write fails, readers see the version before, which stays. A reader that has resolved its
    version keeps it. The log's entry is a file of its own that the commit of its write moves into place, so it is seen
    whole or not at all. Of two writers at once the later number wins, and with equal numbers the later folder name.
    """
    spark = df.sparkSession
    newest = versions(spark, path).agg(F.max("number")).first()[0]
    folder = f"v-{uuid.uuid4().hex}"
    if by:
        writers.replace_partitioned(df, f"{path}/{folder}", by)
    else:
        writers.overwrite_balanced(df, f"{path}/{folder}")
    number = max(time.time_ns() // 1000, (newest or 0) + 1)
    entry = spark.range(1).select(F.lit(number).alias("number"), F.lit(folder).alias("folder"), F.now().alias("written"))
    entry.coalesce(1).write.mode("append").json(f"{path}/{LOG}")
    return folder


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest version, as it is when this is called."""
    folder = current_path(spark, path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(folder)
