from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reckoner.functions.buckets import FOUR_AGES, SEVEN_AGES, bucket
from reckoner.functions.dates import in_year, year_of_epoch
from reckoner.functions.numbers import fixed2_binary, fixed2_half_up, parse_number, ratio
from reckoner.functions.text import drop_trailing_empty, left_text, lower_words, pad_text, split_fields, strip

AGES = [None, 17, 18, 19, 24, 25, 34, 35, 44, 45, 49, 50, 51, 55, 56]


def test_four_ages_are_upper_inclusive(spark):
    df = spark.createDataFrame([(a,) for a in AGES], "age int").select(bucket(F.col("age"), FOUR_AGES))
    labels = ["0-18"] * 2 + ["18-35"] * 5 + ["35-50"] * 4 + ["50+"] * 3
    assert [r[0] for r in rows(df)] == [None, *labels]


def test_seven_ages_differ_at_18_and_35(spark):
    df = spark.createDataFrame([(a,) for a in AGES], "age int").select(bucket(F.col("age"), SEVEN_AGES))
    assert [r[0] for r in rows(df)] == [
        None, "<18", "18-24", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-49", "45-49",
        "50-55", "50-55", "50-55", "56+",
    ]


def _texts(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in rows(df.select(expression(F.col("x"))))]


def test_half_up_and_binary_rounding_differ_on_halves(spark):
    values = [3.775, 4.125, 3.625, 0.5, 2.675, 1.005, None]
    assert _texts(spark, values, fixed2_half_up) == ["3.78", "4.13", "3.63", "0.50", "2.68", "1.01", None]
    assert _texts(spark, values, fixed2_binary) == ["3.77", "4.12", "3.62", "0.50", "2.67", "1.00", None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.floats(-1e9, 1e9),
            st.integers(-(10**7), 10**7).map(lambda n: (2 * n + 1) / 200),
            st.tuples(st.integers(1, 10**5), st.integers(1, 999)).map(lambda t: t[0] / 2 / t[1]),
        ),
        min_size=200,
        max_size=200,
    )
)
def test_two_decimals_match_independent_formatting(spark, values):
    assert _texts(spark, values, fixed2_binary) == [f"{v:.2f}" for v in values]
    half_up = [str(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values]
    assert _texts(spark, values, fixed2_half_up) == half_up


def test_parse_number_null_or_failure_in_any_ansi_mode(spark, conf):
    df = spark.createDataFrame([("7",), (" 8 ",), (None,), ("x",), ("1.5",)], "t string")
    for ansi in ("true", "false"):
        conf(spark__sql__ansi__enabled=ansi)
        lenient = df.select(parse_number(F.col("t"), "int", "null"))
        assert [r[0] for r in rows(lenient)] == [7, 8, None, None, None]
        with pytest.raises(Exception, match="not a valid int: x"):
            df.filter("t = 'x'").select(parse_number(F.col("t"), "int")).collect()
    with pytest.raises(ValueError):
        parse_number(F.col("t"), "int", "ignore")


def test_ratio_is_guarded(spark):
    df = spark.createDataFrame([(6.0, 4), (0.0, 0)], "s double, n int")
    assert rows(df.select(ratio(F.col("s"), F.col("n")), ratio(F.col("s"), F.col("n"), 0.0))) == [
        (1.5, 1.5),
        (None, 0.0),
    ]


def test_year_of_epoch_is_utc_in_any_zone(spark, conf):
    seconds = [1577836800, 1577836799, 0, -1, -86400 * 366, None]
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(year_of_epoch(F.col("s")))
    for zone in ("UTC", "Asia/Ho_Chi_Minh", "America/Los_Angeles"):
        conf(spark__sql__session__timeZone=zone)
        assert [r[0] for r in rows(df)] == [2020, 2019, 1970, 1969, 1968, None]


def test_in_year_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    chosen = orders.filter(in_year(F.col("o_orderdate"), 1998)).select("o_orderkey", "o_orderdate")
    assert "GreaterThanOrEqual(o_orderdate" in plan(chosen)
    assert {r[0].year for r in rows(chosen.select("o_orderdate"))} == {1998}


def test_text_expressions(spark):
    df = spark.createDataFrame([(" \t a b\r\n ",)], "t string")
    assert rows(df.select(strip(F.col("t"))))[0][0] == "a b"
    df = spark.createDataFrame([("Sạch,  TỐT\tlắm ĐẸP",), (None,)], "t string")
    assert [r[0] for r in rows(df.select(lower_words(F.col("t"))))] == [["sạch,", "", "tốt\tlắm", "đẹp"], None]
    df = spark.createDataFrame([("a|b||",)], "t string")
    assert rows(df.select(split_fields(F.col("t"), "|")))[0][0] == ["a", "b", "", ""]
    assert rows(df.select(split_fields(F.col("t"), "|", 2)))[0][0] == ["a", "b||"]
    assert rows(df.select(drop_trailing_empty(F.col("t"), "|")))[0][0] == "a|b"


def test_padding_and_cutting(spark):
    df = spark.createDataFrame([("abc",), ("abcdefgh",)], "t string")
    assert [r[0] for r in rows(df.select(left_text(F.col("t"), 5)))] == ["abc  ", "abcde"]
    assert [r[0] for r in rows(df.select(pad_text(F.col("t"), 5)))] == ["abc  ", "abcdefgh"]
