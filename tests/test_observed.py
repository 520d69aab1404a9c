import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from reckoner.operators.observed import SideResults, best_metrics
from reckoner.operators.rank import best_one
from reckoner.plans import ratings

SHAPE = "movie_id string, title string, avg_rating double, n_ratings bigint"


def observed(spark, df, path, *options):
    side = SideResults(ratings.best_movie_metrics(*options) | {"n": F.count("*")})
    side.watch(df).write.parquet(str(path))
    values = side.values()
    return rows(ratings.best_movie_seen(spark, values)), values["n"]


def test_best_row_of_many_partitions_equals_best_one(spark, tmp_path):
    """Ties of the mean go to the first key as text, in whatever partition it is."""
    rng = random.Random(4)
    data = [(str(i), f"t{i}", rng.randrange(8) / 2, rng.randrange(12)) for i in range(500)]
    df = spark.createDataFrame(data, SHAPE).repartition(7)
    for i, support in enumerate((0, 5, 11)):
        want = rows(best_one(df.filter(F.col("n_ratings") >= support), "avg_rating", "movie_id").drop("movie_id"))
        assert observed(spark, df, tmp_path / str(i), support) == (want, 500)


def test_no_row_none_eligible_and_nulls(spark, tmp_path):
    data = [("a", None, 0.0, 9), ("b", "t", None, 9), ("c", "u", 4.0, None), (None, "v", 0.0, 9)]
    df = spark.createDataFrame(data, SHAPE)
    assert observed(spark, df, tmp_path / "positive", 5, True) == ([], 4)
    assert observed(spark, df, tmp_path / "any", 5) == ([("v", 0.0, 9)], 4)  # a missing key is first among ties
    assert observed(spark, df.limit(0), tmp_path / "empty", 5) == ([], 0)


def test_input_is_read_once(spark, tmp_path):
    """Rows and side result of one action: the source's rows pass once."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(str(i), "t", float(i), 9) for i in range(40)], SHAPE).mapInArrow(count, SHAPE)
    side = SideResults(best_metrics(["title"], "avg_rating", "movie_id", F.lit(True)))
    side.watch(df).write.parquet(str(tmp_path / "out"))
    assert side.values() == {"title": "t"} and passed.value == 40


def test_clashing_names(spark, tmp_path):
    df = spark.createDataFrame([("k", 2.0, 1, 5), ("l", 3.0, 2, 6)], "title string, metric double, less int, tie int")
    side = SideResults(best_metrics(["title", "less", "tie"], "metric", "title", F.lit(True)))
    side.watch(df).write.parquet(str(tmp_path / "out"))
    assert side.values() == {"title": "l", "less": 2, "tie": 6}


@pytest.fixture(autouse=True)
def quiet(spark):
    spark.sparkContext.setLogLevel("ERROR")
