from reckoner.operators import distinct


def total(parts):
    return distinct.estimates(distinct.merged(parts), "n").first().n


def test_parts_merge_and_a_repeated_part_counts_once(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id % 20000 v", "CAST(id % 7 AS int) day")
    parts = distinct.sketches(df, ["day"], "v")
    parts.write.parquet(str(tmp_path / "state"))
    stored = spark.read.parquet(str(tmp_path / "state"))
    assert abs(total(stored) - 20_000) <= 20_000 * distinct.error_bound()
    assert total(stored.unionByName(stored.filter("day = 3"))) == total(stored)
    # Merged by way of coarser keys, the answer is the same.
    weeks = distinct.merged(stored.selectExpr("day < 4 early", "sketch", "has_null"), ["early"])
    assert weeks.count() == 2 and total(weeks) == total(stored)


def test_null_is_one_value_and_few_are_exact(spark):
    rows = [("a", 1), ("a", None), ("b", 1), ("b", 2), ("c", None)]
    parts = distinct.sketches(spark.createDataFrame(rows, "k string, v int"), ["k"], "v")
    assert {r.k: r.n for r in distinct.estimates(parts, "n").collect()} == {"a": 2, "b": 2, "c": 1}
    assert total(parts) == 3


def test_empty(spark):
    none = spark.createDataFrame([], "k string, v int")
    assert distinct.sketches(none, ["k"], "v").count() == 0
    assert total(distinct.sketches(none, ["k"], "v")) == 0
    assert total(distinct.sketches(none, [], "v")) == 0


def test_a_hot_key_is_one_row_per_task_before_the_shuffle(spark):
    from helpers import plan

    df = spark.range(1000, numPartitions=4).selectExpr("id v", "'hot' k")
    text = plan(distinct.sketches(df, ["k"], "v"))
    assert "partial_hll_sketch_agg" in text
