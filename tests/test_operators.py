import random
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from reckoner.operators.aggregate import (
    as_metrics,
    conditional_means,
    count_of,
    distinct_values,
    mean_count,
    means_of_totals,
    totals,
)
from reckoner.operators.enrich import lookup, not_listed, one_per_key
from reckoner.operators.filters import equal_to, more_than, not_empty, parsed_only, with_support
from reckoner.operators.rank import best_one, best_with_ties, by_text_key, nest_top_k, rank_all, top_k_per_group
from reckoner.operators.sets import union_all
from reckoner.operators.tokens import explode_list, explode_words


@pytest.mark.parametrize("salts", [1, 5])
def test_lookup_drops_or_defaults_unmatched(spark, salts):
    fact = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13), (9, 14)], "k int, v int")
    dim = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, name string")
    assert sorted(rows(lookup(fact, dim, "k", salts=salts))) == [(1, 10, "a"), (1, 11, "a"), (2, 12, None)]
    kept = lookup(fact, dim, "k", {"name": "Unknown"}, salts)
    assert sorted(rows(kept.select("v", "name"))) == [
        (10, "a"), (11, "a"), (12, "Unknown"), (13, "Unknown"), (14, "Unknown"),
    ]


def test_one_per_key_is_deterministic(spark):
    dim = spark.createDataFrame([(1, "b", 1), (1, "b", 2), (1, "a", 9), (None, "n", 0)], "k int, s string, i int")
    assert sorted(rows(one_per_key(dim, "k")), key=str) == [(1, "b", 2), (None, "n", 0)]
    assert sorted(rows(one_per_key(dim.select("s"), "s"))) == [("a",), ("b",), ("n",)]


def test_not_listed_keeps_null_and_ignores_repeats(spark):
    words = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c d",)], "word string")
    stop = spark.createDataFrame([("b",), ("b",), ("x y",)], "w string")
    assert Counter(rows(not_listed(words, "word", stop))) == Counter([("a",), ("a",), (None,), ("c d",)])


def test_filters(spark):
    df = spark.createDataFrame([("a", 5), ("A", 4), (None, 6), ("", 3)], "s string, n int")
    assert rows(equal_to(df, "s", "a")) == [("a", 5)]
    assert rows(not_empty(df, "s")) == [("a", 5), ("A", 4)]
    assert [r[1] for r in rows(more_than(df, "n", 5))] == [6]
    assert [r[1] for r in rows(with_support(df, "n", 5))] == [5, 6]
    ages = spark.createDataFrame([("18",), ("x",), (None,), ("",), (" 20 ",)], "age string")
    assert rows(parsed_only(ages, "age", "int")) == [(18,), (20,)]


def test_means_directly_and_by_totals_agree(spark):
    data = [(i % 3, i % 7, float(i % 10) / 2) for i in range(500)]
    df = spark.createDataFrame(data, "a int, b int, v double")
    direct = mean_count(df, ["a"], "v", "m", "n")
    merged = means_of_totals(totals(df, ["a", "b"], "v"), ["a"], "m", "n")
    assert sorted(rows(direct)) == sorted(rows(merged))


def test_null_value_is_no_vote(spark):
    df = spark.createDataFrame([(1, 4.0), (1, None), (2, None)], "k int, v double")
    assert sorted(rows(mean_count(df, ["k"], "v", "m", "n"))) == [(1, 4.0, 1), (2, None, 0)]


def test_conditional_means_ignore_other_labels_but_keep_the_row(spark):
    data = [(1, "M", 4.0), (1, "F", 2.0), (1, "M", 5.0), (2, "other", 3.0), (3, "F", 1.0)]
    df = spark.createDataFrame(data, "k int, g string, v double")
    wide = conditional_means(df, ["k"], "g", {"M": "m", "F": "f"}, "v", "avg_", "n_")
    assert sorted(rows(wide)) == [(1, 4.5, 2, 2.0, 1), (2, None, 0, None, 0), (3, None, 0, 1.0, 1)]


def test_counts_skip_null_and_distinct_counts_it(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), (None, 2), (None, None)], "k string, id int")
    assert sorted(rows(count_of(df, ["k"], "id", "n")), key=str) == [("x", 1), (None, 1)]
    found = df.agg(distinct_values("k").alias("k"), distinct_values("id").alias("id"))
    assert sorted(rows(as_metrics(found, ["k", "id"]))) == [("id", 3), ("k", 2)]
    assert rows(df.filter("false").agg(distinct_values("k"))) == [(0,)]


def test_best_one_breaks_ties_by_key_as_text(spark):
    df = spark.createDataFrame([(9, 4.5), (10, 4.5), (11, 4.0)], "id int, m double")
    assert rows(best_one(df, "m", "id")) == [(10, 4.5)]
    assert rows(by_text_key(df, "id"))[0][0] == 10
    assert rows(best_one(df.filter("false"), "m", "id")) == []


def test_best_with_ties_keeps_all(spark):
    df = spark.createDataFrame([("a", 4), ("b", 4), ("c", 3), (None, 4)], "k string, n int")
    assert sorted(rows(best_with_ties(df, "n")), key=str) == [("a", 4), ("b", 4), (None, 4)]
    assert rows(best_with_ties(df.filter("false"), "n")) == []


def test_top_k_with_tie_at_the_cut_and_nesting(spark):
    data = [("x", w, n) for w, n in [("b", 5), ("a", 5), ("d", 3), ("c", 3), ("e", 9)]] + [("y", "z", 1)]
    df = spark.createDataFrame(data, "g string, w string, n int")
    top = top_k_per_group(df, ["g"], "n", "w", 4)
    assert sorted(rows(top.select("g", "rank", "w", "n"))) == [
        ("x", 1, "e", 9), ("x", 2, "a", 5), ("x", 3, "b", 5), ("x", 4, "c", 3), ("y", 1, "z", 1),
    ]
    nested = {r.g: [tuple(i) for i in r.top] for r in nest_top_k(top, "g", ["w", "n"], "top").collect()}
    assert nested == {"x": [("e", 9), ("a", 5), ("b", 5), ("c", 3)], "y": [("z", 1)]}


def test_rank_all_against_brute_force(spark):
    rng = random.Random(1)
    # A third of the rows tie on one value.
    data = [(i, 7 if i % 3 == 0 else rng.randrange(50), rng.randrange(3)) for i in range(600)]
    data.append((600, None, 1))
    df = spark.createDataFrame(data, "id int, a int, b int")
    got = {r.id: r.rank for r in rank_all(df, ["a", "b"]).collect()}

    def key(row):
        return (row[1] is not None, row[1] or 0, row[2])

    want = {row[0]: 1 + sum(key(other) > key(row) for other in data) for row in data}
    assert got == want


def test_explode_words_and_list(spark):
    df = spark.createDataFrame([(1, "A  b\ta "), (2, None), (3, "")], "id int, t string")
    assert rows(explode_words(df, "t", ["id"])) == [(1, "a"), (1, "b\ta")]
    df = spark.createDataFrame([(1, "x|y"), (2, ""), (3, None)], "id int, l string")
    assert rows(explode_list(df, "l", "|", "item")) == [(1, "x"), (1, "y"), (2, "")]


def test_union_keeps_repeats_and_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "s string, i int")
    assert sorted(rows(union_all([a, b, a]))) == [(1, "x"), (1, "x"), (1, "x"), (2, "y")]
    assert union_all([a]).agg(F.count("*")).first()[0] == 1
