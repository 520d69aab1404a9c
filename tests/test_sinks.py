import glob

from helpers import rows

from reckoner.sinks.writers import (
    delimited_lines,
    dump,
    schema_text,
    table_lines,
    write_delimited,
    write_key_value,
    write_lines,
)
from reckoner.sources.csv import read_declared
from reckoner.sources.text import read_lines


def _data(spark):
    return spark.createDataFrame([("HOTEL", 3), (None, 1), ('a"b', None)], "k string, n int")


def test_semicolon_files_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(_data(spark), path)
    back = read_declared(spark, path, "k string, n int")
    assert sorted(rows(back), key=str) == sorted(rows(_data(spark)), key=str)
    assert sorted(r[0] for r in rows(read_lines(spark, path))) == [";1", "HOTEL;3", 'a"b;']


def test_key_value_is_tab_separated(spark, tmp_path):
    path = str(tmp_path / "out")
    write_key_value(_data(spark), path, "k", "n")
    assert "HOTEL\t3" in [r[0] for r in rows(read_lines(spark, path))]


def test_sorted_lines_stay_sorted_over_part_files(spark, tmp_path):
    path = str(tmp_path / "out")
    lines = spark.range(1000).repartition(8).orderBy("id").selectExpr("lpad(id, 4, '0') AS line")
    write_lines(lines, path)
    text = "".join(open(p).read() for p in sorted(glob.glob(path + "/part-*")))
    assert text.split() == [f"{i:04d}" for i in range(1000)]


def test_values_are_not_escaped(spark):
    df = spark.createDataFrame([("sẽ,", [("a", 1), ("b,c", 2)])], "w string, bag array<struct<x:string,y:int>>")
    assert rows(delimited_lines(df, ";")) == [("sẽ,;{(a,1),(b,c,2)}",)]


def test_a_table_shows_all_its_rows(spark):
    df = spark.createDataFrame([(f"land {i}", i * 1000) for i in range(27)] + [(None, None)], "country string, n int").coalesce(1)
    got = [r[0] for r in rows(table_lines(df))]
    assert got[:5] == ["+-------+-----+", "|country|n    |", "+-------+-----+", "|land 0 |0    |", "|land 1 |1000 |"]
    assert len(got) == 32 and got[-2:] == ["|NULL   |NULL |", "+-------+-----+"]
    assert [r[0] for r in rows(table_lines(df.limit(0)))][1] == "|country|n  |"


def test_previews(spark, capsys):
    df = _data(spark).limit(1)
    dump(df, 1)
    assert capsys.readouterr().out.splitlines()[:-1] == [r[0] for r in rows(table_lines(df))]
    assert rows(table_lines(df))[1] == ("|k    |n  |",)
    assert schema_text(df).strip().splitlines() == [
        "root", " |-- k: string (nullable = true)", " |-- n: integer (nullable = true)",
    ]
