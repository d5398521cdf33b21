"""Open-schema reading of JSON records."""

import json

from pyspark.sql import types as T

from tests.helpers import rows
from wattgrade.sources import records


def read(spark, folder, *lines, **options):
    folder.mkdir(exist_ok=True)
    texts = [line if isinstance(line, str) else json.dumps(line, ensure_ascii=False) for line in lines]
    (folder / "lines.json").write_text("\n".join(texts), encoding="utf-8")
    return records.read_records(spark, str(folder), **options)


def test_envelopes_are_decided_record_by_record(spark, tmp_path):
    found = read(
        spark,
        tmp_path,
        {"a": 1},
        {"source_file": "f", "data": {"a": 2}},
        {"data": [{"a": 3}, {"a": 4}]},
        [{"a": 5}, {"a": 6}],
        {"data": []},
        {"data": 7},
        {"data": {"a": 8}, "b": 1, "c": 2, "d": 3},
    )
    df = records.to_columns(found)
    assert sorted(df.columns) == ["a", "b", "c", "d", "data"]
    assert rows(df.select("a")) == [(1,), (2,), (3,), (4,), (5,), (6,), (None,), (None,)]
    assert found.counts == {"n_lines": 7, "n_records": 8, "n_rejected": 0}
    assert rows(records.to_columns(read(spark, tmp_path, {"rec": {"a": 2}}, envelope="rec"))) == [(2,)]


def test_kinds_of_values(spark, tmp_path):
    found = read(
        spark,
        tmp_path,
        {"n": 1, "x": 1.5, "mixed": 1, "obj": {"p": 1, "q": None}, "list": [1, 2], "none": None, "empty": [], "flag": True},
        {"n": 2, "x": 1e300, "mixed": "s", "obj": {"p": "t"}, "list": [2.5], "none": None, "hollow": {}},
        {"n": 12345678901234567890, "mixed": {"k": 1}, "obj": {"r": [{"z": 1}]}},
    )
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    assert kinds == {
        "n": "double",
        "x": "double",
        "mixed": "string",
        "obj": "struct<p:string,r:array<struct<z:bigint>>>",
        "list": "array<double>",
        "empty": "array<string>",
        "flag": "boolean",
        "hollow": "string",
    }
    got = {r["mixed"]: r for r in records.to_columns(found).collect()}
    assert got["1"]["obj"]["p"] == "1" and got["1"]["list"] == [1.0, 2.0] and got["s"]["x"] == 1e300
    assert got['{"k":1}']["obj"]["r"][0]["z"] == 1 and got["s"]["flag"] is None


def test_unusual_names(spark, tmp_path):
    names = {"N°DPE": 1, "a b.c": 2, "k`t": 3, "we\"ird?'": 4, "x'y": 5, "OBJECT<": 6}
    df = records.to_columns(read(spark, tmp_path, names, {"n°dpe": 7, "Z": "t", "z": 8}))
    assert set(df.columns) == {*names, "Z"}  # names that differ in case alone are one column
    got = [r.asDict() for r in df.collect()]
    assert {**names, "Z": None} in got and any(r["N°DPE"] == 7 and r["Z"] == "t" for r in got)


def test_rejected_lines_keep_their_place(spark, tmp_path):
    found = read(spark, tmp_path, "", {"a": 1}, "{bad", "  ", "null", [1, {"a": 2}], '{"a":1,"a":2}', '"text"')
    got = rows(found.rejected.select("line_no", "reason", "text"))
    assert got == [
        (2, "malformed", "{bad"),
        (4, "no record", "null"),
        (5, "no record", "1"),
        (6, "malformed", '{"a":1,"a":2}'),
        (7, "no record", '"text"'),
    ]
    assert found.counts == {"n_lines": 6, "n_records": 2, "n_rejected": 5}
    assert {r["file_name"] for r in found.rejected.collect()} == {"lines.json"}


def test_whole_documents_and_empty_folders(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name, body in {"one": {"a": 1}, "deep/two": [{"a": 2}, {"a": 3}], "three": {"data": [{"a": 4}]}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body, indent=2), encoding="utf-8")
    found = records.read_records(spark, str(tmp_path), whole=True)
    assert rows(records.to_columns(found)) == [(1,), (2,), (3,), (4,)]
    (tmp_path / "none").mkdir()
    nothing = records.read_records(spark, str(tmp_path / "none"))
    assert nothing.schema == T.StructType() and nothing.counts["n_records"] == 0 and nothing.rejected.count() == 0


def test_layouts_under_common_names(spark):
    df = spark.createDataFrame([(1, None, "x", 5), (None, "b", "y", 6)], "A long, other string, keep string, B long")
    merged = records.merge_layouts(df, {"a": "key"}, {"OTHER": "key", "absent": "gone", "b": "amount"})
    assert merged.columns == ["key", "amount", "keep"]
    assert rows(merged) == [("1", 5, "x"), ("b", 6, "y")]
