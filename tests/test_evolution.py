"""Columns that are added or widened, and changes that are refused before a write."""

import json

import pytest

from paylake.sources import events, evolution
from paylake.sources.tables import FolderTable
from paylake.specs import EntitySpec


def schema(spark, text):
    return spark.createDataFrame([], text).schema


@pytest.mark.parametrize(
    ("old", "new", "wrong"),
    [
        ("k string, n int", "k string, n bigint", []),
        ("k string, n int", "n double, k string, more array<int>", []),
        ("k string, n bigint", "k string, n int", ["n was bigint and is int"]),
        ("k string, n bigint", "k string, n double", ["n was bigint and is double"]),
        ("k string, n int", "k string", ["n is missing"]),
        ("k string, f float", "k string, f double", []),
        ("d decimal(10,2)", "d decimal(12,2)", []),
        ("d decimal(10,2)", "d decimal(12,3)", ["d was decimal(10,2) and is decimal(12,3)"]),
        ("s struct<a:int>", "s struct<a:bigint,b:string>", []),
        ("s struct<a:int,b:string>", "s struct<a:int>", ["s was struct<a:int,b:string> and is struct<a:int>"]),
        ("a array<int>, m map<string,int>", "a array<bigint>, m map<string,bigint>", []),
        ("k string", "k date", ["k was string and is date"]),
        ("t timestamp", "t timestamp_ntz", ["t was timestamp and is timestamp_ntz"]),
    ],
)
def test_problems(spark, old, new, wrong):
    assert evolution.problems(schema(spark, old), schema(spark, new)) == wrong


def test_older_files_are_read_under_the_newer_schema(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = FolderTable(spark, path, ["k"])
    first.upsert(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"))
    wide = schema(spark, "k string, n bigint, more string")
    second = FolderTable(spark, path, ["k"], wide)
    assert second.upsert(spark.createDataFrame([("b", 2**40, "x")], wide))
    assert sorted(map(tuple, second.read().collect())) == [("a", 1, None), ("b", 2**40, "x")]
    assert second.compact()
    assert sorted(map(tuple, FolderTable(spark, path, ["k"]).read().collect())) == [("a", 1, None), ("b", 2**40, "x")]


def test_an_incompatible_change_writes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    FolderTable(spark, path, ["k"]).upsert(spark.createDataFrame([("a", 1)], "k string, n bigint"))
    before = FolderTable(spark, path, ["k"])._folders()
    text = FolderTable(spark, path, ["k"], schema(spark, "k string, n string"))
    with pytest.raises(evolution.SchemaChangeError, match="n was bigint and is string"):
        text.upsert(spark.createDataFrame([("a", "x")], "k string, n string"))
    assert FolderTable(spark, path, ["k"])._folders() == before


def test_undeclared_fields(spark):
    spec = EntitySpec("t", "x", ("id",), "id string, n bigint")
    payloads = [{"id": "a", "n": 1}, {"id": "b", "new": 3, "other": "x"}, {"id": "c", "new": 2.5}, None, {"id": "d", "nested": {"n": 1}}]
    rows = [("t", json.dumps({"timestamp": "", "payload": p})) for p in payloads] + [("t", "garbage"), ("u", '{"payload":{"z":1}}'), ("t", None)]
    got = events.undeclared_fields(spark.createDataFrame(rows, "topic string, raw_payload string"), [spec]).collect()
    assert sorted((r.field, r.records, r.kind) for r in got) == [
        ("nested", 1, "OBJECT<n: BIGINT>"), ("new", 2, "DECIMAL(21,1)"), ("other", 1, "STRING"),
    ]
    assert isinstance(got[0].records, int) and {f.name for f in spec.payload_schema.fields} == {"id", "n"}
