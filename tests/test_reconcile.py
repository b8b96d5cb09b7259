"""Tables whose files differ in schema."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from limelight.sources.reconcile import IncompatibleTypes, common_type, read_reconciled
from limelight.sources.snapshots import read_union_by_name, read_yearly_snapshots


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))


def test_whole_numbers_fractions_and_missing_columns(spark, tmp_path):
    put(spark, tmp_path / "logs" / "run=a", [(1, 1, "x")], "id int, n int, s string")
    put(spark, tmp_path / "logs" / "run=b", [(2**40, 2.5)], "id long, n double")
    put(spark, tmp_path / "logs" / "run=c", [(3, 4, dt.date(2025, 1, 1))], "ID smallint, n byte, day date")
    out = read_union_by_name(spark, str(tmp_path / "logs"))
    assert {f.name.lower(): f.dataType.simpleString() for f in out.schema} == {"id": "bigint", "n": "double", "s": "string", "day": "date", "run": "string"}
    assert sorted(map(tuple, out.select("run", "id", "n", "s", "day").collect())) == [
        ("a", 1, 1.0, "x", None), ("b", 2**40, 2.5, None, None), ("c", 3, 4.0, None, dt.date(2025, 1, 1))]


def test_many_alternating_files_and_a_glob(spark, tmp_path):
    for k in range(7):
        put(spark, tmp_path / f"run={k}" / "summary", [(k,)], "id int" if k % 2 else "id long")
    put(spark, tmp_path / "other" / "summary", [(99,)], "id int")
    out = read_reconciled(spark, str(tmp_path / "run=*" / "summary"))
    assert sorted((r.run, r.id) for r in out.collect()) == [(k, k) for k in range(7)]


def test_nested_fields(spark, tmp_path):
    put(spark, tmp_path / "a", [((1, "x"), [1])], "s struct<n:int,t:string>, l array<int>")
    put(spark, tmp_path / "b", [((2**40, True), [2.5])], "s struct<n:long,b:boolean>, l array<double>")
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "a"), str(tmp_path / "b"))
    out = read_reconciled(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted((r.s.n, r.l[0]) for r in out.collect()) == [(1, 1.0), (2**40, 2.5)]


def test_incompatible_files_are_named(spark, tmp_path):
    put(spark, tmp_path / "logs" / "run=1", [(1,)], "id int")
    put(spark, tmp_path / "logs" / "run=2", [([1],)], "id array<int>")
    with pytest.raises(IncompatibleTypes, match="id.*run=1.*run=2"):
        read_union_by_name(spark, str(tmp_path / "logs"))


def test_yearly_snapshots_keep_later_columns(spark, tmp_path):
    put(spark, tmp_path / "silver" / "w" / "year=2024", [(1,)], "views int")
    put(spark, tmp_path / "silver" / "w" / "year=2025", [(2**40, "en")], "views long, language string")
    out = read_yearly_snapshots(spark, str(tmp_path), "w")
    assert sorted((r.year, r.views, r.language) for r in out.collect()) == [(2024, 1, None), (2025, 2**40, "en")]


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_reconciled(spark, str(tmp_path))


@pytest.mark.parametrize("a, b, want", [
    ("tinyint", "bigint", "bigint"), ("float", "float", "float"), ("float", "double", "double"), ("bigint", "float", "double"), ("int", "decimal(5,2)", "decimal(12,2)"),
    ("decimal(10,0)", "decimal(5,4)", "decimal(14,4)"), ("date", "timestamp", "timestamp"), ("int", "string", "string"), ("void", "array<int>", "array<int>"),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("boolean", "int", None), ("binary", "string", None), ("struct<a:int>", "int", None), ("date", "int", None)])
def test_lattice(spark, a, b, want):
    a, b = (T._parse_datatype_string(x) if x != "void" else T.NullType() for x in (a, b))
    for x, y in ((a, b), (b, a)):
        if want is None:
            with pytest.raises(IncompatibleTypes):
                common_type(x, y)
        else:
            assert common_type(x, y).simpleString() == want
