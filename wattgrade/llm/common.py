"""Helpers that several operators share: tables, sizes, hashes, numbering of sorted rows, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import cycle

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattgrade.session import staged

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, so a Python worker holds few texts at once beside its batch, which Arrow holds.

    What Arrow no longer needs goes back to the system at the end, since the worker lives on for tasks of other stages.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(value: Column) -> Column:
    """The first 60 bits of the MD5 of a string, as a non-negative long."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id's decimal text leaves the given remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Rows with their position (long, from 0) in the given order, without bringing them into one task.

    A range partitioning sorts the rows; one count per partition gives each partition its offset.
    """
    placed = staged(
        df.sort(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (
        placed.join(F.broadcast(offsets), "_part")  # one row per partition of the sort
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_part", "_at", "_shift")
    )


def large_star(pairs: DataFrame) -> DataFrame:
    """Hands each node's larger neighbours to the smallest node it knows."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    # Nodes whose neighbours are all larger keep their links through those neighbours.
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(pairs: DataFrame) -> DataFrame:
    """Hands each node and its smaller neighbours to the smallest of these."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    small = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components: (node, component), component being the smallest node, for every node of an edge.

    Alternates the large-star and small-star steps: each node hands its larger neighbours, then its smaller ones, to
    the smallest node it knows. Every step is an aggregate and a join, written to the shared folder, so nothing
    depends on an earlier executor and no node's neighbours are gathered in one task. Ends when one step of each kind
    in a row changes nothing. Nulls and loops are ignored; empty edges give no rows.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    pairs = staged(pairs.where("u is not null and v is not null and u != v").distinct(), "edges")
    state, unchanged = None, 0
    for step, name in cycle(((large_star, "large-star"), (small_star, "small-star"))):
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        unchanged = unchanged + 1 if now == state else 0
        if unchanged == 2:
            break
        state = now
        pairs = staged(step(pairs).where("u != v").distinct(), name)
    roots = pairs.groupBy("u").agg(F.min("v").alias("component"))
    named = roots.select(F.col("u").alias("node"), "component")
    return named.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged(named: DataFrame, edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of the graph of ``named``, its nodes with their components, and of further edges.

    Only the components that the edges touch are worked on again, each as one node.
    """
    ends = edges.select(left, right)
    for end in (left, right):
        known = named.select(F.col("node").alias(end), F.col("component").alias("_known"))
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce("_known", end)).drop("_known")
    moved = staged(components(ends, left, right), "merged")
    # A component's number is a node of its own, so this adds the nodes that were in no component.
    nodes = named.select("node", "component").unionByName(moved.select("node", F.col("node").alias("component"))).distinct()
    moved = moved.select(F.col("node").alias("component"), F.col("component").alias("_now"))
    return nodes.join(moved, "component", "left").select("node", F.coalesce("_now", "component").alias("component"))
