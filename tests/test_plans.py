"""What the plans of the registered queries must and must not hold."""

import random
import re
import subprocess

import pytest
from helpers import plan, rows

import __spark_entry__
from checks.queries import QUERIES
from reckoner.operators.enrich import one_per_key
from reckoner.plans import ratings as plans
from reckoner.plans import reviews
from reckoner.sources.memory import from_values

SF = "/root/testdata/sf0.001"
QUERIES = QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_rows(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def _read_schemas(text):
    return re.findall(r"ReadSchema: struct<(.*?)>\n", text)


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["q_gender_avg_zero"](spark, SF))
    assert sorted(_read_schemas(text)) == [
        "l_orderkey:bigint,l_partkey:bigint,l_quantity:double",
        "o_orderkey:bigint,o_orderstatus:string",
        "p_partkey:bigint,p_name:string,p_size:int",
    ]
    assert _read_schemas(plan(QUERIES["q_year_avg"](spark, SF))) == ["l_quantity:double,l_shipdate:timestamp_ntz"]
    assert _read_schemas(plan(QUERIES["q_reviews_by_aspect"](spark, SF))) == ["doc_id:bigint,source:string"]


def test_aggregates_are_partial_before_the_shuffle(spark):
    for name in ("q_movie_avg_outer", "q_genre_avg", "q_word_count", "q_age7_avg", "q_totals"):
        text = plan(QUERIES[name](spark, SF))
        assert "partial_" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_means_per_movie_share_one_shuffle_with_the_lookup(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES["q_movie_avg_outer"](spark, SF))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2  # line items once, parts once


def test_top_words_are_trimmed_before_the_shuffle(spark):
    text = plan(QUERIES["q_top5_words"](spark, SF))
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2
    assert re.search(r"^\(\d+\) BroadcastHashJoin.*\n(?:.*\n){1,4}Join type: LeftAnti", text, re.M)


def test_long_stop_list_meets_counts_instead_of_words(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    docs = spark.createDataFrame([(1, "a b a", "x")], "id int, review string, category string")
    text = plan(reviews.top_words(docs, from_values(spark, ["b"], "word")))
    tree = text[: text.index("\n\n\n")]
    assert tree.index("SortMergeJoin LeftAnti") < tree.index("HashAggregate")


def test_maximum_reuses_the_counts(spark):
    df = QUERIES["q_top_negative_aspect"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_hot_user_is_split_over_tasks(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    rng = random.Random(5)
    # One user gave a third of all ratings.
    data = [(0 if i % 3 == 0 else rng.randrange(1, 400), rng.randrange(50), i % 10 / 2) for i in range(30000)]
    ratings = spark.createDataFrame(data, "user_id int, movie_id int, rating double").repartition(16)
    users = spark.createDataFrame([(u, "MF"[u % 2]) for u in range(400)], "user_id int, gender string")
    movies = spark.createDataFrame([(m, f"m{m}") for m in range(50)], "movie_id int, title string")
    for salts, people in ((1, users), (4, one_per_key(users, "user_id"))):
        df = plans.gender_means_all(ratings, people, movies, salts)
        got = {r.movie_id: (r.avg_male, r.avg_female) for r in df.collect()}
        # Salting alone spreads the user evenly here, with nothing left to split.
        assert "skew=true" in plan(df) if salts == 1 else "__salt" in plan(df)
        for movie in range(50):
            for position, remainder in ((0, 0), (1, 1)):
                values = [v for u, m, v in data if m == movie and u % 2 == remainder]
                assert got[movie][position] == pytest.approx(sum(values) / len(values))


def test_library_sets_no_cluster_options_and_makes_no_local_checkpoint():
    found = subprocess.run(
        ["grep", "-rnE", "--exclude-dir=llm", r"localCheckpoint|conf\.set|\.rdd\b|toLocalIterator|crossJoin|toPandas|F\.broadcast|\.collect\(\)",
         "reckoner", "checks/queries.py", "checks/star.py"],
        cwd=__spark_entry__.os.path.dirname(__spark_entry__.__file__), capture_output=True, text=True,
    )
    assert found.stdout == ""


def test_hot_word_and_whole_texts(spark):
    long_text = "hot " * 20000 + "tail"
    docs = spark.createDataFrame([(i, long_text, "x") for i in range(3)], "id int, review string, category string")
    counts = dict(rows(reviews.word_frequency(docs)))
    assert counts == {"hot": 60000, "tail": 3}
