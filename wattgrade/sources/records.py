"""JSON records of any shape: schema, envelope and layout come from the records themselves.

One pass parses each line to a variant, looks into its envelope and keeps what is no record with its place. The schemas of
all parsed records are merged as an aggregate, and columns are taken from them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrade.session import work_path

MALFORMED, NO_RECORD = "malformed", "no record"
# An object with more keys than this is a record, even if one of them is called like the envelope's.
MAX_OUTER = 3
PLAIN_NAME = re.compile(r'[^"?\\]+')


@dataclass(frozen=True)
class Records:
    """What one pass over the text found.

    ``parsed`` holds ``record`` (variant, always an object); ``rejected`` holds file_name, block_start (the byte at which
    the file's split begins), line_no (from 0 within that split, blank lines counted), reason and text; ``schema`` is the
    union of the schemas of all records, without fields that are null everywhere; ``counts`` has n_lines (blank lines
    left out), n_records and n_rejected.
    """

    parsed: DataFrame
    rejected: DataFrame
    schema: T.StructType
    counts: Mapping[str, int]


def _object(value: Column) -> Column:
    """Fields of a variant that is an object, else null."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _entries(line: Column, envelope: str) -> Column:
    """The records of a parsed line: of a root array its elements, of an envelope its content, else the line."""
    fields = _object(line)
    content = F.when(F.size(fields) <= MAX_OUTER, F.try_element_at(fields, F.lit(envelope)))
    elements = F.try_variant_get(content, "$", "array<variant>")
    content = F.when(elements.isNotNull() | _object(content).isNotNull(), content)
    body = F.coalesce(content, line)
    return F.coalesce(F.try_variant_get(body, "$", "array<variant>"), F.array(body))


def read_records(spark: SparkSession, path: str | Sequence[str], envelope: str = "data", whole: bool = False) -> Records:
    """Every record under a path, one a line (``whole``: one document a file), in folders of any depth.

    A line may be a record, an array of records, or an object of at most three keys whose ``envelope`` is one of these;
    lines of all kinds may stand side by side. Not records, and kept as rejected: text that is no JSON, that repeats a
    key in an object or is beyond the size of a variant, and JSON values that are no object. Text after a
    complete value is ignored, as Spark's JSON reader does. Blank lines count as nothing. An empty folder gives no records and an empty schema; a missing one is an error.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    place = [F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("block_start")]
    text = reader.text(path, wholetext=whole).select("value", *place, F.monotonically_increasing_id().alias("at"))
    text = text.withColumn("filled", ~F.regexp_like("value", F.lit(r"^\s*$")))
    parsed = text.withColumn("line", F.try_parse_json("value"))
    # Lines without an entry stay as rows without a record, so that line numbers count them.
    entries = parsed.select("*", F.posexplode_outer(_entries(F.col("line"), envelope)).alias("entry", "record"))
    malformed = F.col("filled") & F.col("line").isNull()
    good = _object(F.col("record")).isNotNull()
    reason = F.when(malformed, MALFORMED).when(F.col("record").isNotNull() & ~good, NO_RECORD)
    rejected_text = F.when(malformed, F.col("value")).when(reason.isNotNull(), F.to_json("record"))
    sorted_out = entries.select(
        "file_name",
        "block_start",
        "at",
        reason.alias("reason"),
        rejected_text.alias("text"),
        F.when(good, F.col("record")).alias("record"),
        (F.col("filled") & (F.coalesce("entry", F.lit(0)) == 0)).alias("begins"),  # the first entry of its line
        reason.isNotNull().alias("rejected"),
    )
    # One read, two folders: what is a record and what is not.
    out = work_path(spark, "records")
    sorted_out.write.partitionBy("rejected").parquet(out)
    stored = spark.read.schema(sorted_out.schema).parquet(out)
    firsts = stored.groupBy("file_name", "block_start").agg(F.min("at").alias("first"))
    rejected = stored.where("rejected").join(firsts, ["file_name", "block_start"])
    # Over the parsed values: an observation of the write would say the same, but a session that holds one can no longer
    # send its machine-learning functions to tasks.
    found = stored.agg(
        F.count_if(F.col("begins")).alias("n_lines"),
        F.count("record").alias("n_records"),
        F.count_if(F.col("rejected")).alias("n_rejected"),
        F.schema_of_variant_agg("record").alias("kind"),
    ).first()
    counts = {c: found[c] for c in ("n_lines", "n_records", "n_rejected")}
    return Records(
        stored.where("not rejected and record is not null").select("record"),
        rejected.select(
            "file_name", "block_start", (F.col("at") - F.col("first")).alias("line_no"), "reason", "text"
        ),
        merged_schema(found["kind"]),
        counts,
    )


def merged_schema(kind: str | None) -> T.StructType:
    """Columns for a merged variant schema such as ``OBJECT<a: BIGINT, b: VOID>``."""
    if not kind or not kind.startswith("OBJECT<"):
        return T.StructType()
    quoted = re.split(r"(`(?:[^`]|``)*`)", kind)
    text = "".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in quoted)
    return _column_type(T.DataType.fromDDL(text)) if text != "STRUCT<>" else T.StructType()


def _column_type(kind: T.DataType) -> T.DataType | None:
    """Numbers with a fraction become doubles and values of mixed kinds text; null everywhere means no column."""
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.StructType):
        fields = [(f.name, _column_type(f.dataType)) for f in kind.fields]
        kept = [T.StructField(name, t) for name, t in fields if t is not None]
        return T.StructType(kept) if kept else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_column_type(kind.elementType) or T.StringType())
    if isinstance(kind, T.DecimalType | T.FloatType):
        return T.DoubleType()
    return T.StringType() if isinstance(kind, T.VariantType) else kind


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        inner = ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind.fields)
        return f"struct<{inner}>"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


def _field(record: Column, field: T.StructField) -> Column:
    if PLAIN_NAME.fullmatch(field.name):
        return F.try_variant_get(record, f'$["{field.name}"]', _ddl(field.dataType))
    return F.try_variant_get(F.try_element_at(_object(record), F.lit(field.name)), "$", _ddl(field.dataType))


def to_columns(records: Records) -> DataFrame:
    """The records as columns, all that hold a value anywhere. Names that differ in case alone are one column, whose
    value is the first in the order of the names; a value that does not fit its column's type is null."""
    groups: dict[str, list[T.StructField]] = {}
    for field in sorted(records.schema.fields, key=lambda f: f.name):
        groups.setdefault(field.name.lower(), []).append(field)
    columns = []
    for fields in groups.values():
        kinds = {_ddl(f.dataType) for f in fields}
        if len(kinds) > 1:
            numbers = kinds <= {"bigint", "double"}
            fields = [T.StructField(f.name, T.DoubleType() if numbers else T.StringType()) for f in fields]
        columns.append(F.coalesce(*[_field(F.col("record"), f) for f in fields]).alias(fields[0].name))
    return records.parsed.select(*columns)


def merge_layouts(df: DataFrame, *layouts: Mapping[str, str]) -> DataFrame:
    """Columns of several layouts under common names, decided record by record: a target takes the first of its sources
    that is filled, in the order of the layouts. Other columns keep their names."""
    present = {c.lower(): c for c in df.columns}
    sources: dict[str, list[str]] = {}
    for layout in layouts:
        for name, target in layout.items():
            column = present.get(name.lower())
            if column is not None and column not in sources.setdefault(target, []):
                sources[target].append(column)
    sources = {target: found for target, found in sources.items() if found}
    taken = {c for found in sources.values() for c in found}
    for c in df.columns:
        if c not in taken:
            sources.setdefault(c, []).append(c)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for target, found in sources.items():
        values = [F.col(f"`{c.replace('`', '``')}`") for c in found]
        if len({kinds[c].simpleString() for c in found}) > 1:
            values = [v.cast("string") for v in values]
        columns.append(F.coalesce(*values).alias(target))
    return df.select(*columns)
