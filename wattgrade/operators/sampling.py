"""Ordered limits, samples and splits that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def hashed_sample(df: DataFrame, key: str, n: int = 800) -> DataFrame:
    """min(n, rows) rows in the order of the key's hash: exact size, same rows on every run."""
    others = [c for c in df.columns if c != key]
    return df.orderBy(F.md5(F.col(key).cast("string")), key, *others).limit(n)


def hashed_share(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """About ``rows`` rows, or all if there are no more, by the hash of the keys: no sort, the same rows on every run."""
    total = df.count()
    if total <= rows:
        return df
    span = 1 << 31
    return df.where(F.pmod(F.xxhash64(*[f"`{k}`" for k in keys]), F.lit(span)) < int(span * rows / total))


def split_bucket(*key: str) -> Column:
    """0..9 from the first four hex digits of the key's hash."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int") % 10


def in_training(*key: str, tenths: int = 8) -> Column:
    """Whether the hash of the key columns puts a row on the training side, wherever the row is stored."""
    return split_bucket(*key) < tenths


def hashed_split(df: DataFrame, *key: str, tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows."""
    train = in_training(*key, tenths=tenths)
    return df.where(train), df.where(~train)
