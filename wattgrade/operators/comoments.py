"""Pairwise-complete co-moments of many columns in one pass.

Each task multiplies matrices of its rows and hands over one table per pair of column blocks: for each pair of columns
the rows that have both, their means, squared deviations and co-moment. Two such tables merge exactly, so no sum of
large squares is ever subtracted from another, and nothing grows with the square of all columns in one row or task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of one block: a table of a pair of blocks has the square of it as entries.
BLOCK = 32
# Tasks whose tables are merged together before the last merge.
FAN_IN = 64
FIGURES = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "c")
_TABLE = "block_a int, block_b int, part int, " + ", ".join(f"{f} array<double>" for f in FIGURES)


def middle(values: np.ndarray, has: np.ndarray) -> np.ndarray:
    """Of each column the value next to its mean: deviations from it are small, so the differences of their products lose
    nothing, and in a column that does not vary they are exactly zero."""
    mean = np.where(has, values, 0.0).sum(0) / np.maximum(has.sum(0), 1)
    at = np.where(has, np.abs(values - mean), np.inf).argmin(0)
    return np.where(has.any(0), values[at, np.arange(values.shape[1])], 0.0)


def deviations(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a block of columns: the values next to the means, the deviations from them, their squares, and where there are
    values; NaN is missing. Prepared once for all the pairs that a block is in."""
    has = ~np.isnan(x)
    near = middle(x, has)
    dx = np.where(has, x - near, 0.0)
    return near, dx, dx * dx, has.astype(float)


def moments_of(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...]) -> np.ndarray:
    """The six figures, each a matrix of columns of x by columns of y, both as deviations."""
    (near_x, dx, xx, in_x), (near_y, dy, yy, in_y) = x, y
    n = in_x.T @ in_y
    some = np.maximum(n, 1)
    sx, sy = dx.T @ in_y, in_x.T @ dy
    qx, qy = xx.T @ in_y, in_x.T @ yy
    return np.stack(
        [
            n,
            near_x[:, None] + sx / some,
            near_y[None, :] + sy / some,
            np.maximum(qx - sx * sx / some, 0.0),
            np.maximum(qy - sy * sy / some, 0.0),
            dx.T @ dy - sx * sy / some,
        ]
    )


def merged(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Figures of the rows of both."""
    n = p[0] + q[0]
    weight = np.divide(q[0], n, out=np.zeros_like(n), where=n > 0)
    da, db = q[1] - p[1], q[2] - p[2]
    da, db = np.where(p[0] > 0, da, 0.0), np.where(p[0] > 0, db, 0.0)
    joint = p[0] * weight
    mean_a = np.where(p[0] > 0, p[1] + da * weight, q[1])
    mean_b = np.where(p[0] > 0, p[2] + db * weight, q[2])
    out = [n, mean_a, mean_b, p[3] + q[3] + da * da * joint, p[4] + q[4] + db * db * joint, p[5] + q[5] + da * db * joint]
    return np.where((q[0] > 0)[None], np.stack(out), p)


def _row(key: tuple[int, int, int], table: np.ndarray) -> pa.RecordBatch:
    lists = [pa.array([figure.ravel()], pa.list_(pa.float64())) for figure in table]
    ids = [pa.array([k], pa.int32()) for k in key]
    return pa.RecordBatch.from_arrays(ids + lists, ["block_a", "block_b", "part", *FIGURES])


def co_moments(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(a, b, n, mean_a, mean_b, m2_a, m2_b, c) for every pair a, b of the columns, each pair once and each column with
    itself, over the rows in which neither is null or NaN: sums of squared deviations m2 and of their products c.

    A pair without such a row has n = 0 and means of no meaning; an empty table gives no rows.
    """
    columns = list(columns)
    cuts = [slice(i, i + block) for i in range(0, len(columns), block)]
    pairs = [(i, j) for i in range(len(cuts)) for j in range(i, len(cuts))]

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("_part")[0].as_py()
            values = [batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(len(columns))]
            rows = np.stack(values, axis=1).astype(float)
            blocks = [deviations(rows[:, cut]) for cut in cuts]
            for i, j in pairs:
                now = moments_of(blocks[i], blocks[j])
                held[i, j] = merged(held[i, j], now) if (i, j) in held else now
        for (i, j), table in held.items():
            yield _row((i, j, part), table)

    def merge(group: pa.Table) -> pa.Table:
        key = tuple(group.column(c)[0].as_py() for c in ("block_a", "block_b", "part"))
        shape = (len(columns[cuts[key[0]]]), len(columns[cuts[key[1]]]))
        total = None
        for row in range(group.num_rows):
            table = np.stack([np.array(group.column(f)[row].values).reshape(shape) for f in FIGURES])
            total = table if total is None else merged(total, table)
        return pa.Table.from_batches([_row(key, total)])

    named = df.select(*[F.col(f"`{c}`").cast("double") for c in columns], F.spark_partition_id().alias("_part"))
    found = named.mapInArrow(tables, _TABLE)
    for part in (F.col("part") % FAN_IN, F.lit(0)):
        found = found.withColumn("part", part.cast("int"))
        found = found.groupBy("block_a", "block_b", "part").applyInArrow(merge, _TABLE)

    # A pair's place in its table gives the two columns.
    names = F.array(*[F.lit(c) for c in columns])
    width = F.least(F.lit(block), F.lit(len(columns)) - F.col("block_b") * block)
    entries = found.select("block_a", "block_b", F.posexplode(F.arrays_zip(*FIGURES)).alias("place", "figures"))
    a = (F.col("block_a") * block + F.floor(F.col("place") / width)).cast("int")
    b = (F.col("block_b") * block + F.col("place") % width).cast("int")
    placed = entries.select(a.alias("_a"), b.alias("_b"), "figures.*").where("_a <= _b")
    return placed.select(
        F.element_at(names, F.col("_a") + 1).alias("a"),
        F.element_at(names, F.col("_b") + 1).alias("b"),
        F.col("n").cast("long").alias("n"),
        *FIGURES[1:],
    )
