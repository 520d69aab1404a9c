"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__
from checks.compare import connect, difference
from checks.queries import QUERIES
from checks.sql import SQL

SF = "/root/testdata/sf0.001"
# Few words of the smallest tables occur more than 500 times; all other queries have rows.
MAY_BE_EMPTY = {"q_word_count_over"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, name) in (("", "no rows") if name in MAY_BE_EMPTY else ("",))


@pytest.mark.parametrize(
    "name",
    [
        "q_gender_avg_null", "q_age7_avg", "q_occupation_avg", "q_year_avg", "q_orders_by_country",
        "q_orders_by_month", "q_review_scores", "report_gender_lines", "report_year_lines",
    ],
)
def test_sorted_query_has_the_order_of_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({SQL[name]})").fetchall()
    assert [tuple(r) for r in df.collect()] == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(__spark_entry__.queries())


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["movie_id", "title", "avg_rating", "n_ratings"]
    assert df.count() > 0
