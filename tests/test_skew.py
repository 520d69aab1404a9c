import random
from collections import Counter

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from reckoner.operators.enrich import lookup
from reckoner.operators.skew import copied, hot_keys, lookup_skewed, spread


@pytest.fixture(scope="module")
def ratings(spark):
    """User 7 gave a third of all ratings, user 9 a tenth; a tenth have no user."""
    rng = random.Random(2)
    user = lambda i: 7 if i % 3 == 0 else None if i % 10 == 1 else 9 if i % 10 == 2 else rng.randrange(10, 3000)
    return spark.createDataFrame([(user(i), i, i % 5 / 2) for i in range(30000)], "user_id long, movie_id int, rating double").repartition(6).cache()


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(u, f"u{u}") for u in [*range(2500), None]], "user_id long, name string")


def test_hot_keys_are_found(ratings):
    found = {r.user_id: r for r in hot_keys(ratings, "user_id", 0.05).collect()}
    n = Counter(r.user_id for r in ratings.select("user_id").collect())
    assert set(found) == {7, 9}
    for key, row in found.items():
        assert row.rows == pytest.approx(n[key], rel=0.02)
        assert row.parts == -(-row.rows // 1500)


def test_no_part_holds_much_more_than_the_share(ratings):
    dealt = spread(ratings, hot_keys(ratings, "user_id", 0.05), "user_id", 20)
    parts = dealt.groupBy("user_id", "__salt").count().collect()
    assert max(r["count"] for r in parts) <= 1.2 * 0.05 * 30000
    assert {r["__salt"] for r in parts if r.user_id not in (7, 9, None)} == {0}


def test_only_dimension_rows_of_hot_keys_are_copied(ratings, users):
    hot = hot_keys(ratings, "user_id", 0.05)
    n = Counter(r.user_id for r in copied(users, hot, "user_id").select("user_id").collect())
    parts = {r.user_id: r.parts for r in hot.collect()}
    assert n == {u: parts.get(u, 1) for u in range(2500)}


@pytest.mark.parametrize("defaults", [None, {"name": "?"}])
def test_lookup_skewed_equals_lookup(ratings, users, defaults):
    known = users.filter("user_id IS NOT NULL")
    want = lookup(ratings, known, "user_id", defaults)
    got = lookup_skewed(ratings, users, "user_id", defaults, share=0.05)
    assert got.columns == want.columns
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_the_fact_is_shuffled_once_and_the_sketch_reads_one_column(ratings, users, conf, spark, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    ratings.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    text = plan(lookup_skewed(stored, users, "user_id", share=0.05))
    main = text[: text.index("===== Subqueries")]
    assert main.count("hashpartitioning(user_id") == 2  # both sides of the one join
    assert "ReadSchema: struct<user_id:bigint>" in text


def test_share_must_be_a_share(ratings):
    for share in (0, 1, 2):
        with pytest.raises(ValueError, match="share"):
            hot_keys(ratings, "user_id", share)


def test_without_facts_or_with_text_keys(spark, users):
    none = spark.createDataFrame([], "user_id long, rating double")
    assert lookup_skewed(none, users, "user_id").count() == 0
    facts = spark.createDataFrame([("a", 1)] * 50 + [("b", 2), (None, 3)], "k string, n int")
    dim = spark.createDataFrame([("a", "A"), ("c", "C")], "k string, name string")
    got = lookup_skewed(facts, dim, "k", {"name": "-"}, share=0.3)
    assert Counter(rows(got.select("k", "name"))) == {("a", "A"): 50, ("b", "-"): 1, (None, "-"): 1}


def test_rows_equal_in_all_columns_are_kept(spark):
    facts = spark.createDataFrame([(1,)] * 100, "k int")
    dim = spark.createDataFrame([(1, "x")], "k int, name string")
    assert lookup_skewed(facts, dim, "k", share=0.1).agg(F.count("*")).first()[0] == 100
