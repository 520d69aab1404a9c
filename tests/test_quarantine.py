import os

import pytest
from helpers import rows

from reckoner.sources.quarantine import bad_rows, checked, good_rows, parse_apart, read_lines_with_file
from reckoner.sources.text import Dialect

SCHEMA = "id int, name string, score double"


def verdicts(spark, lines, dialect=Dialect(), required=()):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return {r["value"]: (r["problem"], r["id"], r["name"], r["score"]) for r in checked(df, SCHEMA, dialect, required).collect()}


def test_each_problem(spark):
    got = verdicts(spark, ["1,a,2.5", "1,a", "x,a,1", "1,a,y", "x,a,y", "", "1,,", "1,a,2,3", "2147483648,a,1"], required=["id"])
    assert got["1,a,2.5"] == (None, 1, "a", 2.5)
    assert got["1,a"][0] == "fields: 2"
    assert got["x,a,1"][0] == got["x,a,y"][0] == "number: id"
    assert got["1,a,y"][0] == "number: score"
    assert got[""][0] == "fields: 1"
    assert got["1,,"] == (None, 1, "", None)
    assert got["1,a,2,3"] == (None, 1, "a", 2.0)
    assert got["2147483648,a,1"][0] == "number: id"


def test_required_and_dialects(spark):
    assert verdicts(spark, [",a,1"])[",a,1"] == (None, None, "a", 1.0)
    assert verdicts(spark, [",a,1"], required=["id"])[",a,1"][0] == "empty: id"
    assert verdicts(spark, [" 1 , a , 2 "], Dialect(trim=True))[" 1 , a , 2 "] == (None, 1, "a", 2.0)
    assert verdicts(spark, ["1,a,2,3"], Dialect(bounded=True))["1,a,2,3"][0] == "number: score"
    assert verdicts(spark, ["1,a,"], Dialect(trailing_empty=False))["1,a,"][0] == "fields: 2"
    assert verdicts(spark, [None])[None][0] == "no line"
    with pytest.raises(ValueError, match="no column"):
        verdicts(spark, ["1"], required=["other"])


def test_both_sets_are_all_lines_with_their_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1,a,1\n2,b\n")
    (tmp_path / "b.txt").write_text("x,c,3\n4,d,4\n")
    lines = read_lines_with_file(spark, str(tmp_path))
    good, bad = parse_apart(lines, SCHEMA, Dialect())
    assert sorted(rows(good)) == [(1, "a", 1.0), (4, "d", 4.0)]
    assert sorted((p, v, os.path.basename(f)) for p, v, f in rows(bad)) == [("fields: 2", "2,b", "a.txt"), ("number: id", "x,c,3", "b.txt")]


def test_lines_are_read_once_where_there_is_a_folder(spark, tmp_path):
    lines = spark.createDataFrame([("1,a,1",), ("1",)], "value string")
    good, bad = parse_apart(lines, SCHEMA, Dialect(), folder=f"file://{tmp_path}/shared")
    assert good.inputFiles() and sorted(good.inputFiles()) == sorted(bad.inputFiles())
    assert rows(good) == [(1, "a", 1.0)] and rows(bad) == [("fields: 1", "1")]


def test_without_lines(spark):
    rows_ = checked(spark.createDataFrame([], "value string"), SCHEMA, Dialect())
    assert good_rows(rows_, SCHEMA).count() == bad_rows(rows_).count() == 0
