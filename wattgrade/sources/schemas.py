"""Schemas of the raw files.

Raw fields are read as text and turned into numbers by the cleaning step, so a number stored as text, or text where a
number belongs, costs a null in one cell and never the record.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from wattgrade.roles import ACCENTED_NAMES, CONSUMPTION_NAMES, MODEL_ROLES, SNAKE_NAMES


def text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def envelope_schema(schema: T.StructType, column: str = "data") -> T.StructType:
    return T.StructType([T.StructField("source_file", T.StringType()), T.StructField(column, schema)])


_MODEL_NAMES = (
    MODEL_ROLES.key,
    MODEL_ROLES.commune,
    MODEL_ROLES.commune_name,
    *MODEL_ROLES.categoricals,
    *MODEL_ROLES.numerics,
    MODEL_ROLES.intensity,
)

ACCENTED_RECORD = text_schema(ACCENTED_NAMES)
SNAKE_RECORD = text_schema(dict.fromkeys([*SNAKE_NAMES, *_MODEL_NAMES]))
CONSUMPTION_RECORD = text_schema(CONSUMPTION_NAMES)
CONSUMPTION_DOCUMENT = T.StructType([T.StructField("data", CONSUMPTION_RECORD)])
