"""What the vector operators share: valid vectors, blocks of packed rows, principal axes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACKED = "block long, ids binary, data binary"


def usable(vector: Column) -> Column:
    """True for vectors that are not null, not zero, not empty, and hold finite components only."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def clean_vectors(df: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, list[int]]:
    """(id, v) of usable vectors with an id, and the lengths that several of them have: a vector that is the only one of
    its length has nothing to be compared with. Most tables have one length."""
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().where("count > 1").orderBy("d").collect()
    return rows, [r["d"] for r in lengths]


def pack(rows: DataFrame, block: str) -> DataFrame:
    """One row per block: the ids in ascending order and the vectors as doubles, row by row.

    Blocks are of bounded size because callers deal rows to a number of blocks that follows the row count.
    """

    def packed(key: tuple, group: pa.Table) -> pa.Table:
        ids = group["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        data = flat.reshape(len(ids), -1)[order]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int64()),
                "ids": pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()),
                "data": pa.array([np.ascontiguousarray(data, dtype=np.float64).tobytes()], pa.binary()),
            }
        )

    return rows.select(F.col(block).cast("long").alias("block"), "id", "v").groupBy("block").applyInArrow(packed, PACKED)


def unpack(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    known = np.frombuffer(ids, np.int64)
    return known, np.frombuffer(data, np.float64).reshape(len(known), -1)


def principal_axes(rows: DataFrame, dimension: int) -> np.ndarray:
    """Orthonormal axes (dimension x dimension), strongest first, of the unit vectors' second moments.

    Each task adds up its own matrix; the driver receives the sum, whose size depends on the dimension alone.
    """

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dimension, dimension))
        for frame in frames:
            if len(frame):
                x = np.stack(frame["v"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                total += x.T @ x
        yield pd.DataFrame({"cell": np.arange(dimension * dimension), "value": total.ravel()})

    sums = rows.select("v").mapInPandas(moments, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    matrix = np.zeros(dimension * dimension)
    for cell, value in sums.collect():  # dimension squared values
        matrix[cell] = value
    values, axes = np.linalg.eigh(matrix.reshape(dimension, dimension))
    return np.ascontiguousarray(axes[:, np.argsort(-values)])
