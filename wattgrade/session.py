"""Session settings and the shared work folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Keeps streaming state on disk with a memory cache, so it may outgrow the executor's memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Whether a query's shuffle files go when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# (application, weak reference to the files' index, path) of every staged table that may still be read.
_watched: list[tuple] = []
_lock = threading.Lock()


def build_session(app_name: str = "wattgrade", **settings: str) -> SparkSession:
    """A session with adaptive execution and disk-backed streaming state; the rest comes from the cluster or caller."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, else one in the warehouse, which a session always has."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other call has used."""
    return f"{shared_root(spark)}/wattgrade/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting inside; then as before."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _watch(table: DataFrame, path: str) -> None:
    """Every plan that reads the table holds the index of its files. Other kinds of plans are not watched."""
    plan = table._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation":
        spark = table.sparkSession
        seen = spark._jvm.java.lang.ref.WeakReference(plan.relation().location())
        with _lock:
            _watched.append((spark.sparkContext.applicationId, seen, path))


def drop_unread(spark: SparkSession) -> None:
    """Delete the staged tables that no plan can read any more, as far as the driver's garbage collection has found out."""
    with _lock:
        mine = [w for w in _watched if w[0] == spark.sparkContext.applicationId]
        gone = {path for _, seen, path in mine if seen.refersTo(None)}
        _watched[:] = [w for w in mine if w[2] not in gone]
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table once and read it back.

    Later plans start from the files, so a lost executor costs no recomputation of ``df``, and Spark plans
    joins from the real file sizes. The query's shuffle files go when it ends, and the table when no plan refers to it.
    """
    return staged_parts(df.sparkSession, [df], purpose)


def staged_parts(spark: SparkSession, parts: Iterable[DataFrame], purpose: str) -> DataFrame:
    """Write tables of one schema, one at least, each before the next is made, and read all of them back as one."""
    path = work_path(spark, purpose)
    with setting(spark, CLEANUP, "true"):
        for part in parts:
            drop_unread(spark)
            part.write.mode("append").parquet(path)
    table = spark.read.schema(part.schema).parquet(path)
    _watch(table, path)
    return table
