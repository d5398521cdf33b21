"""Sources, sinks and message encoding."""

import gc
import json
import os
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import rows
from wattgrade import session
from wattgrade.operators import shaping
from wattgrade.sources import messages, readers, versions, writers
from wattgrade.sources.schemas import envelope_schema, text_schema

AB = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_lines_and_documents_read_differently(spark, tmp_path):
    for name in ("one.json", "two.json"):
        write(tmp_path, name, "\n".join(json.dumps({"a": i, "b": name}) for i in range(5)))
    assert readers.read_json_lines(spark, str(tmp_path), AB).count() == 10
    assert readers.read_json_documents(spark, str(tmp_path), AB).count() == 2


def test_document_array_is_a_row_per_element(spark, tmp_path):
    write(tmp_path, "doc.json", json.dumps([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], indent=1))
    assert rows(readers.read_json_documents(spark, str(tmp_path), AB)) == [(1, "x"), (2, "y")]


def test_malformed_line_stays_as_a_row(spark, tmp_path):
    write(tmp_path, "l.json", '{"a": 1, "b": "x"}\n{"a": 2, "b"\n{"a": 3, "b": "z"}\n')
    found = readers.read_json_lines(spark, str(tmp_path), AB, keep_corrupt=True).cache()
    assert found.count() == 3
    assert [r[readers.CORRUPT] for r in found.where(F.col(readers.CORRUPT).isNotNull()).collect()] == ['{"a": 2, "b"']
    found.unpersist()


def test_nested_directories_and_dated_partitions(spark, tmp_path):
    write(f"{tmp_path}/date=2026-03-11", "x.json", '{"a": 1, "b": "x"}')
    write(f"{tmp_path}/date=2026-03-12", "y.json", '{"a": 2, "b": "y"}\n{"a": 3, "b": "z"}')
    assert readers.read_json_lines(spark, str(tmp_path), AB, nested=True).count() == 3
    day = readers.read_dated_lines(spark, str(tmp_path), AB, "2026-03-12")
    assert rows(day) == [(2, "y", "2026-03-12"), (3, "z", "2026-03-12")]
    assert len(day.inputFiles()) == 2 and "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().toString()


def test_delimited_is_all_text_and_wraps_with_its_file_name(spark, tmp_path):
    write(tmp_path, "adresses.csv", "id;rue;ville\n01;Rue de l'Été;Orléans\n2;;Lyon\n")
    df = readers.read_delimited(spark, str(tmp_path), ["id", "rue", "ville"])
    assert rows(df) == sorted([("01", "Rue de l'Été", "Orléans"), ("2", None, "Lyon")], key=repr)
    wrapped = shaping.wrap(df)
    assert wrapped.schema["data"].dataType == text_schema(["id", "rue", "ville"])
    assert {r["source_file"] for r in wrapped.collect()} == {"adresses.csv"}
    body = json.loads(messages.encode_rows(wrapped).first()["value"])
    assert set(body) == {"source_file", "data"}
    back = messages.decode_rows(messages.encode_rows(wrapped), envelope_schema(df.schema))
    assert rows(shaping.unwrap(back)) == rows(df)


def test_corrupt_message_keeps_its_text(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("{oops",)], "value string")
    assert rows(messages.decode_rows(df, AB, "bad")) == [(1, "x", None), (None, None, "{oops")]


def test_pages_are_bounded_and_complete(spark):
    df = spark.range(2500).repartition(3)
    pages = writers.page_up(df, size=100)
    assert pages.agg(F.max(F.size("results"))).first()[0] <= 100
    assert rows(readers.flatten_pages(pages)) == rows(df)
    empty = spark.createDataFrame([([],)], "results array<struct<a: int>>")
    assert readers.flatten_pages(empty).count() == 0


def test_merged_read_and_missing_prefix(spark, out):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    writers.overwrite(spark.createDataFrame([(1,)], "a bigint"), f"{out}/p1")
    writers.overwrite(spark.createDataFrame([("x", 2)], "b string, a bigint"), f"{out}/p2")
    assert rows(readers.read_merged(spark, out, schema)) == [(1, None), (2, "x")]
    missing = readers.read_merged(spark, f"{out}/nowhere", schema)
    assert missing.schema == schema and missing.count() == 0


def test_first_files_and_manifest(spark, out):
    df = spark.range(70).repartition(7)
    df.write.parquet(out)
    found = readers.read_first_files(spark, out, df.schema, n=5)
    paths = sorted(r["path"] for r in readers.list_files(spark, out).collect())
    assert len(paths) == 7
    assert rows(found) == rows(spark.read.parquet(*paths[:5]))
    assert readers.file_rows(spark.read.parquet(out)).agg(F.sum("n_rows")).first()[0] == 70
    assert readers.read_first_files(spark, out, df.schema, pattern="*.none").count() == 0


def test_partition_overwrite_keeps_other_grades(spark, out):
    writers.overwrite_partitions(spark.createDataFrame([(1, "A"), (2, "B")], "x int, g string"), out, ["g"])
    writers.overwrite_partitions(spark.createDataFrame([(3, "B")], "x int, g string"), out, ["g"])
    assert rows(readers.read_dataset(spark, out).select("x", "g")) == [(1, "A"), (3, "B")]


def test_file_count_and_extract(spark, out):
    df = spark.range(1000)
    writers.overwrite_balanced(df, f"{out}/ten", files=10)
    assert readers.list_files(spark, f"{out}/ten").count() == 10
    writers.write_extract(df, f"{out}/csv", ["id"])
    assert readers.list_files(spark, f"{out}/csv", "*.csv").count() == 1
    found = readers.read_delimited(spark, f"{out}/csv", ["id"], sep=",")
    assert sorted(int(r[0]) for r in found.collect()) == list(range(10))
    writers.write_json_lines(df.coalesce(1), f"{out}/json", per_file=100)
    assert readers.list_files(spark, f"{out}/json", "*.json").count() == 10


def test_topic_options_need_the_connector_only_when_used(spark, tmp_path):
    write(tmp_path, "l.json", '{"a": 1, "b": "x"}')
    feed = spark.readStream.schema(AB).json(str(tmp_path))
    assert messages.send_stream(feed, "broker:9092", "records", f"{tmp_path}/check")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        messages.topic_stream(spark, "broker:9092", "records", per_trigger=1000)


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert versions.versions(spark, path).count() == 0 and versions.current_path(spark, path) == path
    versions.publish(spark.range(5), path)
    held = versions.read_current(spark, path)
    with pytest.raises(PySparkException, match="broken off"):
        broken = F.when(F.col("id") == 7, F.raise_error(F.lit("broken off")).cast("long")).otherwise(F.col("id"))
        versions.publish(spark.range(9).select(broken.alias("id")), path)
    assert versions.read_current(spark, path).count() == 5 and versions.versions(spark, path).count() == 1
    folder = versions.publish(spark.range(12).withColumn("part", F.col("id") % 2), path, ["part"])
    assert versions.current_path(spark, path) == f"{path}/{folder}"
    assert held.count() == 5 and versions.read_current(spark, path).agg(F.sum("id")).first()[0] == 66
    numbers = [r["number"] for r in versions.versions(spark, path).collect()]
    assert len(numbers) == len(set(numbers)) == 2


def test_an_empty_version_is_read_as_no_rows(spark, tmp_path):
    empty = versions.publish(spark.range(0), str(tmp_path / "t"))
    assert versions.current_path(spark, str(tmp_path / "t")).endswith(empty)
    assert versions.read_current(spark, str(tmp_path / "t")).count() == 0


def test_lines_are_compressed_and_files_bounded(spark, out):
    from wattgrade.sources import records

    lines = spark.range(0, 2500, 1, 1).select(F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit("}")).alias("value"))
    writers.write_lines(lines, out, per_file=1000)
    files = readers.list_files(spark, out, "*.txt.gz").collect()
    assert len(files) == 3 and sum(f["length"] for f in files) < 2500 * 7
    found = records.read_records(spark, out)
    assert found.counts == {"n_lines": 2500, "n_records": 2500, "n_rejected": 0}


def test_work_tables_and_shuffle_files_go_when_nothing_reads_them(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: {b for b in files.getAllFiles().mkString(",").split(",") if "shuffle" in b}

    def collected():
        gc.collect()
        spark._jvm.System.gc()
        session.drop_unread(spark)

    def soon(done, step=lambda: None):
        end = time.time() + 30
        while not done() and time.time() < end:
            step()
            time.sleep(0.2)
        return done()

    before = shuffled()
    table = session.staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "read-later")
    assert soon(lambda: shuffled() <= before)
    folder = next(Path(session.shared_root(spark).removeprefix("file:"), "wattgrade").glob("read-later-*"))
    derived = table.where("k > 2")
    del table
    collected()
    assert derived.count() == 4 and folder.exists()
    del derived
    assert soon(lambda: not folder.exists(), collected)
