"""Streams give what the batch gives, and restarts add nothing twice."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import rows
from wattgrade.operators import quality
from wattgrade.roles import Roles
from wattgrade.sources import messages, readers
from wattgrade.streaming import accounts, ingest

ROLES = Roles(key="id", received="day", grade="grade", ordinal="ord", intensity="x", surface="s", total="t")
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "day", "grade", "x", "t", "s")])


def records(spark, start, n):
    i = F.col("id")
    return spark.range(start, start + n).select(
        i.cast("string").alias("id"),
        F.lit("2024-01-01").alias("day"),
        F.element_at(F.array(*[F.lit(g) for g in "ABCH"]), (i % 4 + 1).cast("int")).alias("grade"),
        (i % 2500).cast("string").alias("x"),
        F.lit("100").alias("t"),
        F.when(i % 10 == 0, "8").otherwise("80").alias("s"),
    )


def test_silver_stream_equals_batch(spark, out):
    records(spark, 0, 3000).repartition(3).write.json(f"{out}/in")
    feed = ingest.file_feed(spark, f"{out}/in", SCHEMA, fmt="json", files_per_trigger=1)
    silver = ingest.silver_stream(feed, ROLES)
    ingest.run_to_end(ingest.land(silver, f"{out}/silver", f"{out}/check", fmt="parquet", by=["grade"]))
    batch = quality.row_rules(records(spark, 0, 3000), ROLES)
    found = readers.read_dataset(spark, f"{out}/silver", silver.schema).select(*batch.columns)
    assert rows(found) == rows(batch)


def test_restart_adds_only_new_records(spark, out):
    def run():
        feed = ingest.file_feed(spark, f"{out}/in", SCHEMA, fmt="json")
        ingest.run_to_end(ingest.land(feed, f"{out}/bronze", f"{out}/check"))
        return readers.read_json_lines(spark, f"{out}/bronze", SCHEMA).count()

    records(spark, 0, 500).write.json(f"{out}/in")
    assert run() == 500
    assert run() == 500
    records(spark, 500, 250).write.mode("append").json(f"{out}/in")
    assert run() == 750


def test_numbered_batches_continue_after_a_restart(spark, out):
    def run():
        feed = ingest.file_feed(spark, f"{out}/in", SCHEMA, fmt="json", files_per_trigger=1)
        ingest.run_to_end(ingest.land_numbered(feed, f"{out}/bronze", f"{out}/check", per_file=100))

    records(spark, 0, 600).coalesce(1).write.json(f"{out}/in")
    run()
    records(spark, 600, 300).coalesce(1).write.mode("append").json(f"{out}/in")
    run()
    found = spark.read.schema(SCHEMA).json(f"{out}/bronze")
    assert sorted((r["batch"], r["count"]) for r in found.groupBy("batch").count().collect()) == [(0, 600), (1, 300)]
    assert readers.list_files(spark, f"{out}/bronze", "*.json").count() == 9


def test_last_partial_batch_and_bad_messages_are_kept(spark, out):
    body = F.to_json(F.struct(F.col("id").cast("string").alias("id")))
    bodies = spark.range(1003).select(F.when(F.col("id") == 7, "{oops").otherwise(body).alias("value"))
    bodies.write.text(f"{out}/in")
    feed = ingest.file_feed(spark, f"{out}/in", T.StructType([T.StructField("value", T.StringType())]), fmt="text")
    decoded = messages.decode_rows(feed, T.StructType([T.StructField("id", T.StringType())]), readers.CORRUPT)
    ingest.run_to_end(ingest.land(decoded, f"{out}/bronze", f"{out}/check", fmt="parquet"))
    found = spark.read.parquet(f"{out}/bronze")
    assert found.count() == 1003
    assert [r[readers.CORRUPT] for r in found.where("id is null").collect()] == ["{oops"]


@pytest.mark.parametrize("salts", [1, 4])
def test_redelivered_records_come_out_once(spark, out, salts):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    events = spark.range(400).select(
        F.col("id").alias("k"), (start + F.make_dt_interval(secs=F.col("id"))).alias("ts")
    )
    for part in range(2):
        events.coalesce(1).write.mode("append").parquet(f"{out}/in")
    feed = ingest.file_feed(spark, f"{out}/in", schema, files_per_trigger=1)
    once = ingest.first_seen(feed, ["k"], "ts", "1 hour", salts)
    ingest.run_to_end(ingest.land(once, f"{out}/out", f"{out}/check", fmt="parquet"))
    assert sorted(r["k"] for r in spark.read.parquet(f"{out}/out").collect()) == list(range(400))


def test_late_and_forgotten_keys_are_told_apart(spark, out):
    schema = T.StructType([T.StructField("a key", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("_v", T.StringType())])

    def deliver(*records):
        rows_in = spark.createDataFrame([(k, h, v) for k, h, v in records], "k long, h int, v string")
        at = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(hours=F.col("h"))
        rows_in.select(F.col("k").alias("a key"), F.when(F.col("h") >= 0, at).alias("ts"), F.col("v").alias("_v")).write.mode(
            "append"
        ).parquet(f"{out}/in")
        feed = ingest.file_feed(spark, f"{out}/in", schema)
        told = accounts.first_seen_and_late(feed, ["a key"], "ts", delay_seconds=7200)
        ingest.run_to_end(ingest.land(told, f"{out}/out", f"{out}/check", fmt="parquet", by=["late"]))
        found = readers.read_dataset(spark, f"{out}/out")
        return sorted((r["_v"], str(r["late"]).capitalize()) for r in found.collect())

    first = [("a", "False"), ("b", "False")]
    assert deliver((1, 0, "a"), (1, 1, "a2"), (2, 0, "b")) == first
    # The key is known; the watermark moves to ten o'clock.
    assert deliver((1, 1, "a3"), (3, 12, "c")) == [*first, ("c", "False")]
    # Behind the watermark, known or not: late. Ahead of it, a key forgotten meanwhile is first again.
    last = deliver((2, 9, "d"), (4, 3, "e"), (1, 11, "f"), (3, 12, "c2"), (5, -1, "none"))
    assert last == [*first, ("c", "False"), ("d", "True"), ("e", "True"), ("f", "False"), ("none", "True")]


def test_late_records_are_told_with_the_state_store_that_a_session_has_by_default(spark, out):
    name = "spark.sql.streaming.stateStore.providerClass"
    stored = spark.conf.get(name)
    schema = T.StructType([T.StructField("k", T.TimestampType()), T.StructField("n", T.LongType()), T.StructField("ts", T.TimestampType())])

    def deliver(micros, n, hours):
        keys = [F.timestamp_micros(F.lit(m).cast("long")) for m in micros]
        rows_in = spark.range(1).select(F.explode(F.array(*keys)).alias("k"), F.explode(F.array(F.lit(n), F.lit(None))).alias("n"))
        at = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(hours=F.lit(hours))
        rows_in.select("k", F.col("n").cast("long").alias("n"), at.alias("ts")).write.mode("append").parquet(f"{out}/in")
        feed = ingest.file_feed(spark, f"{out}/in", schema)
        told = accounts.first_seen_and_late(feed, ["k", "n"], "ts", delay_seconds=3600, buckets=2)
        ingest.run_to_end(ingest.land(told, f"{out}/out", f"{out}/check", fmt="parquet", by=["late"]))
        found = spark.read.parquet(f"{out}/out").groupBy(F.col("late").cast("string").alias("late")).count().collect()
        return {r["late"]: r["count"] for r in found}

    try:
        spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
        assert deliver([1, 2, 1, 2, None], 5, 0) == {"false": 6}
        assert deliver([1, 2, 3], 5, 9) == {"false": 8}
        assert deliver([1], 5, 2) == {"false": 8, "true": 2}
    finally:
        spark.conf.set(name, stored)
