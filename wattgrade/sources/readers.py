"""Batch scans. Every reader takes the schema, so no job is spent on inference."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_json_documents(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """One document per file: a root object is one row, a root array one row per element."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    keep_corrupt: bool = False,
    nested: bool = False,
) -> DataFrame:
    """One record per line. Malformed lines stay as rows with their text if asked for.

    ``nested`` looks into directories of any depth, which turns off columns from directory names.
    """
    if keep_corrupt and CORRUPT not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("recursiveFileLookup", nested).json(path)


def read_dated_lines(spark: SparkSession, base: str, schema: T.StructType, day: str) -> DataFrame:
    """Records of one ``date=`` directory; the filter is on the partition column, so no other file is opened."""
    with_date = T.StructType([*schema.fields, T.StructField("date", T.StringType())])
    return spark.read.schema(with_date).json(base).where(F.col("date") == day)


def read_delimited(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Delimited text with a header, every field as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("sep", sep).option("header", True).option("encoding", "UTF-8").csv(path)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet dataset directory; columns kept in directory names come back as columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_merged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every Parquet file under a prefix by column name, or an empty frame of the same schema if there is none.

    The union of the file schemas is the stated one, so no footer is read to find it out.
    """
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length, modificationTime) of the files under a prefix; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def file_rows(df: DataFrame) -> DataFrame:
    """(file_name, n_rows) of a frame read from files: the check of what has landed."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_rows"))


def read_first_files(
    spark: SparkSession, path: str, schema: T.StructType, n: int = 5, pattern: str = "*.parquet"
) -> DataFrame:
    """Rows of the first n files in path order. At most n paths reach the driver."""
    paths = [r["path"] for r in list_files(spark, path, pattern).select("path").orderBy("path").limit(n).collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def flatten_pages(pages: DataFrame, results: str = "results") -> DataFrame:
    """One row per record of each stored page; an empty page gives none."""
    return pages.select(F.inline(results))


def concat_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones null, duplicates kept."""
    frames = iter(frames)
    result = next(frames)
    for frame in frames:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
