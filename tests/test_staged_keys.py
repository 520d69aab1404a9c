import re

import pytest
from helpers import plan, rows

from checks.queries import staged_by_order
from checks.star import Star
from reckoner.operators.aggregate import row_count
from reckoner.plans import orders
from reckoner.sources.staging import clean, stage_by_key


@pytest.fixture
def shuffled_joins(conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def exchanges(df):
    return re.findall(r"^\(\d+\) Exchange", plan(df), re.M)


def test_two_staged_tables_join_without_a_shuffle(spark, shuffled_joins):
    delivered, limits = staged_by_order(Star(spark, "/root/testdata/sf0.001"))
    assert not exchanges(delivered.join(limits, "order_id"))
    assert len(exchanges(orders.delivery_delay(delivered, limits))) == 1  # of the one row per task
    assert not exchanges(row_count(limits, ["order_id"], "n"))
    clean(spark)


def test_only_the_other_side_is_shuffled(spark, shuffled_joins, tmp_path):
    staged = stage_by_key(spark.range(1000).selectExpr("id", "id * 2 AS twice"), ["id"], str(tmp_path))
    facts = spark.range(3000).selectExpr("id % 700 AS id", "id AS fact")
    joined = facts.join(staged, "id")
    assert len(exchanges(joined)) == 1
    assert sorted(rows(joined.select("fact", "twice"))) == [(i, i % 700 * 2) for i in range(3000)]
    clean(spark)
    assert not list(tmp_path.iterdir()) and not [t for t in spark.catalog.listTables() if t.name.startswith("stage_")]


def test_null_and_repeated_keys_and_no_rows(spark, tmp_path):
    shape = "a int, b string, v int"
    data = [(None, "x", 1), (None, "x", 2), (1, None, 3), (1, "y", 4), (1, "y", 4)]
    staged = stage_by_key(spark.createDataFrame(data, shape), ["a", "b"], str(tmp_path))
    assert sorted(map(str, rows(staged))) == sorted(map(str, data))
    assert sorted(map(str, rows(row_count(staged, ["a", "b"], "n")))) == sorted(["(None, 'x', 2)", "(1, None, 1)", "(1, 'y', 2)"])
    empty = stage_by_key(spark.createDataFrame([], shape), ["a"], str(tmp_path))
    assert rows(empty) == [] and empty.columns == ["a", "b", "v"]
    clean(spark)
