import random

import duckdb
import pytest
from helpers import plan, rows

from reckoner.operators.rank import ntile_all
from reckoner.plans import orders


@pytest.mark.parametrize("n", [1, 3, 10, 11, 97, 1000])
def test_tiles_of_distinct_values_are_those_of_sql(spark, n):
    values = random.Random(n).sample(range(10 * n), n)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    for tiles in (1, 4, 10, 200):
        want = duckdb.sql(f"SELECT v, ntile({tiles}) OVER (ORDER BY v DESC) FROM (SELECT unnest({values}) AS v)").fetchall()
        assert sorted(rows(ntile_all(df, ["v"], tiles))) == sorted(want)


def test_equal_rows_share_a_tile_and_nulls_are_last(spark):
    data = [(5, "a")] * 6 + [(4, "b"), (3, "c"), (None, "d"), (None, "e")]
    df = spark.createDataFrame(data, "v int, tile_of string").repartition(3)
    got = sorted(map(str, rows(ntile_all(df, ["v"], 5))))
    assert got == sorted(["(5, 'a', 1)"] * 6 + ["(4, 'b', 4)", "(3, 'c', 4)", "(None, 'd', 5)", "(None, 'e', 5)"])
    assert rows(ntile_all(df.limit(0), ["v"], 5)) == []


def test_rows_are_ranked_by_range_not_in_one_window(spark):
    text = plan(ntile_all(spark.range(100).toDF("v"), ["v"], 10))
    whole = [w for w in text.split("\n\n") if "] Window\n" in w or ") Window\n" in w]
    assert whole and sum("__part" not in w for w in whole) == 0


def test_limits_follow_the_customers(spark):
    """Values ten times as large give the same segments; fixed limits do not."""
    shape = "order_id int, customer_id int, purchased_at timestamp, order_value decimal(14,2)"

    def made(factor):
        rng = random.Random(3)
        sql = "SELECT * FROM VALUES " + ", ".join(
            f"({i}, {int(rng.paretovariate(1)) % 50}, TIMESTAMP '2024-01-{1 + rng.randrange(28)}', {factor * rng.randrange(100)}.0)" for i in range(600)
        )
        return spark.sql(sql).toDF("order_id", "customer_id", "purchased_at", "order_value").to(spark.createDataFrame([], shape).schema)

    one, ten = (sorted((r.customer_id, r.segment) for r in orders.customer_segments_by_share(made(f), 0.75).collect()) for f in (1, 10))
    assert one == ten and len({s for _, s in one}) > 2
    assert rows(orders.customer_segments_by_share(made(1).limit(0))) == []
