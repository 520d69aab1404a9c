"""Whole programs: input files to output folders of text.

    PYTHONPATH=. spark-submit reckoner/jobs.py NAME input=path ... out=folder [min_support=5 ...]
    python -m reckoner.jobs                      # lists names and inputs

The session is whatever the submission configures. Results that feed several
outputs are staged once and removed at the end; every output is written by the
tasks that hold it. Limits that a program fixes are options with its value as
default. A best row is observed while the rows it is the best of are written.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckoner.operators.filters import more_than
from reckoner.operators.observed import SideResults
from reckoner.operators.rank import by_text_key
from reckoner.operators.sets import union_all
from reckoner.plans import orders, ratings, reviews
from reckoner.sinks import reports
from reckoner.sinks.writers import delimited_lines, schema_text, write_lines
from reckoner.sources import datasets
from reckoner.sources.memory import from_values
from reckoner.sources.staging import clean, stage
from reckoner.sources.text import BOUNDED_STRICT, TRIMMED_LENIENT, TRIMMED_STRICT

# Options and their defaults. Users from files are reduced to one row per id, and
# the join reuses that shuffle; more than one salt splits hot users in it, at the
# price of as many copies of the user table.
OPTIONS = {"min_support": 5, "more_than": 500, "k": 5, "year": 2024, "user_salts": 1}

Paths = Mapping[str, str]
Later = Callable[[], DataFrame]
# Written in order; an output that rests on what an earlier one observed is made when its turn comes.
Outputs = dict[str, DataFrame | Later]


class Job(NamedTuple):
    inputs: tuple[str, ...]
    build: Callable[[SparkSession, Paths], Outputs]


# The columns of ratings that the programs read.
MOVIE_RATINGS = ["movie_id", "rating"]
USER_RATINGS = ["user_id", "movie_id", "rating"]


def _option(paths: Paths, name: str) -> int:
    return int(paths.get(name, OPTIONS[name]))


# Trimmed comma files, tab-separated results in the text order of the key. The
# ratings input is a file or a folder.


def movie_pairs(spark: SparkSession, paths: Paths) -> Outputs:
    rated = datasets.read_ratings(spark, paths["ratings"], TRIMMED_STRICT, MOVIE_RATINGS)
    movies = datasets.read_movies(spark, paths["movies"], TRIMMED_STRICT, ["movie_id", "title"])
    support = _option(paths, "min_support")
    best = SideResults(ratings.best_movie_metrics(support, positive_only=True))
    means = best.watch(by_text_key(ratings.movie_means_keep_unknown(rated, movies), "movie_id"))
    return {
        "means": reports.movie_pairs(means),
        "champion": lambda: reports.champion_pair(ratings.best_movie_seen(spark, best.values()), support),
    }


def genre_pairs(spark: SparkSession, paths: Paths) -> Outputs:
    rated = datasets.read_ratings(spark, paths["ratings"], TRIMMED_STRICT, MOVIE_RATINGS)
    movies = datasets.read_movies(spark, paths["movies"], TRIMMED_STRICT, ["movie_id", "genres"])
    return {"means": reports.genre_pairs(by_text_key(ratings.genre_means(rated, movies), "genre"))}


def gender_pairs(spark: SparkSession, paths: Paths) -> Outputs:
    rated = datasets.read_ratings(spark, paths["ratings"], TRIMMED_LENIENT, USER_RATINGS)
    movies = datasets.read_movies(spark, paths["movies"], TRIMMED_LENIENT, ["movie_id", "title"])
    users = datasets.read_users(spark, paths["users"], TRIMMED_LENIENT, ["user_id", "gender"])
    means = ratings.gender_means_known(rated, users, movies, _option(paths, "user_salts"))
    return {"means": reports.gender_pairs(by_text_key(means, "movie_id"))}


def age4_pairs(spark: SparkSession, paths: Paths) -> Outputs:
    rated = datasets.read_ratings(spark, paths["ratings"], TRIMMED_LENIENT, USER_RATINGS)
    movies = datasets.read_movies(spark, paths["movies"], TRIMMED_LENIENT, ["movie_id", "title"])
    users = datasets.read_users(spark, paths["users"], TRIMMED_LENIENT, ["user_id", "age"], skip_bad_age=True)
    means = ratings.age4_means(rated, users, movies, _option(paths, "user_salts"))
    return {"means": reports.age4_pairs(by_text_key(means, "movie_id"))}


# Comma files whose last field takes further commas, two rating files,
# fixed-width results under a header.


def _rating_parts(spark: SparkSession, paths: Paths, columns: Sequence[str]) -> list[DataFrame]:
    return [datasets.read_ratings(spark, paths[p], BOUNDED_STRICT, columns) for p in ("ratings_1", "ratings_2")]


def _movies(spark: SparkSession, paths: Paths, column: str) -> DataFrame:
    return datasets.read_movies(spark, paths["movies"], BOUNDED_STRICT, ["movie_id", column])


def _users(spark: SparkSession, paths: Paths, column: str) -> DataFrame:
    return datasets.read_users(spark, paths["users"], BOUNDED_STRICT, ["user_id", column])


def movie_lines(spark: SparkSession, paths: Paths) -> Outputs:
    parts = _rating_parts(spark, paths, MOVIE_RATINGS)
    support = _option(paths, "min_support")
    best = SideResults(ratings.best_movie_metrics(support))
    means = best.watch(ratings.movie_means_known(parts, _movies(spark, paths, "title")))

    def winner() -> DataFrame:
        line = reports.winner_line(ratings.best_movie_seen(spark, best.values()), support)
        return reports.with_header(line, reports.WINNER_HEADER % support)

    return {"means": reports.with_header(reports.movie_lines(means), reports.MOVIES_HEADER), "winner": winner}


def genre_lines(spark: SparkSession, paths: Paths) -> Outputs:
    rated = union_all(_rating_parts(spark, paths, MOVIE_RATINGS))
    means = ratings.genre_means(rated, _movies(spark, paths, "genres"), keep_empty=True)
    return {"means": reports.with_header(reports.genre_lines(means), reports.GENRES_HEADER)}


def gender_lines(spark: SparkSession, paths: Paths) -> Outputs:
    rated = union_all(_rating_parts(spark, paths, USER_RATINGS))
    users, movies = _users(spark, paths, "gender"), _movies(spark, paths, "title")
    means = ratings.gender_means_all(rated, users, movies, _option(paths, "user_salts"))
    return {"means": reports.with_header(reports.gender_lines(means), reports.GENDERS_HEADER)}


def age7_lines(spark: SparkSession, paths: Paths) -> Outputs:
    rated = union_all(_rating_parts(spark, paths, USER_RATINGS))
    users, movies = _users(spark, paths, "age"), _movies(spark, paths, "title")
    means = ratings.age7_means(rated, users, movies, _option(paths, "user_salts"))
    return {"means": reports.with_header(reports.age7_lines(means), reports.AGES_HEADER)}


def occupation_lines(spark: SparkSession, paths: Paths) -> Outputs:
    rated = union_all(_rating_parts(spark, paths, USER_RATINGS))
    names = datasets.read_occupations(spark, paths["occupations"], BOUNDED_STRICT)
    means = ratings.occupation_means(rated, _users(spark, paths, "occupation_id"), names)
    return {"means": reports.with_header(reports.occupation_lines(means), reports.OCCUPATIONS_HEADER)}


def year_lines(spark: SparkSession, paths: Paths) -> Outputs:
    means = ratings.year_means(union_all(_rating_parts(spark, paths, ["rating", "rated_at"])))
    return {"means": reports.with_header(reports.year_lines(means), reports.YEARS_HEADER)}


# Reviews, semicolon-separated results.


def _semicolon(df: DataFrame) -> DataFrame:
    return delimited_lines(df, ";")


def clean_words(spark: SparkSession, paths: Paths) -> Outputs:
    read = datasets.read_reviews(spark, paths["reviews"])
    stop = datasets.read_stop_words(spark, paths["stop_words"])
    return {"words": _semicolon(reviews.clean_words(read, stop))}


def word_counts(spark: SparkSession, paths: Paths) -> Outputs:
    read = datasets.read_reviews(spark, paths["reviews"])
    counts = stage(reviews.word_frequency(read))
    return {
        "all_words": _semicolon(counts),
        "frequent_words": _semicolon(more_than(counts, "total_words", _option(paths, "more_than"))),
        "categories": _semicolon(reviews.reviews_by(read, "category")),
        "aspects": _semicolon(reviews.reviews_by(read, "aspect")),
    }


def _extremes(spark: SparkSession, paths: Paths, ties: bool) -> Outputs:
    counts = stage(reviews.aspect_sentiment_counts(datasets.read_reviews(spark, paths["reviews"])))
    return {s: _semicolon(reviews.top_of_counts(counts, s, ties)) for s in (reviews.NEGATIVE, reviews.POSITIVE)}


def top_aspects(spark: SparkSession, paths: Paths) -> Outputs:
    return _extremes(spark, paths, ties=True)


def top_aspect(spark: SparkSession, paths: Paths) -> Outputs:
    return _extremes(spark, paths, ties=False)


def top_words_by_sentiment(spark: SparkSession, paths: Paths) -> Outputs:
    read = datasets.read_reviews(spark, paths["reviews"])
    stop = datasets.read_stop_words(spark, paths["stop_words"])
    top = stage(reviews.top_words_by_sentiment(read, stop, k=_option(paths, "k")))
    return {
        s: _semicolon(reviews.nested_top_words(top.filter(F.col("sentiment") == s).drop("sentiment")))
        for s in (reviews.POSITIVE, reviews.NEGATIVE)
    }


def top_words(spark: SparkSession, paths: Paths) -> Outputs:
    read = datasets.read_reviews(spark, paths["reviews"])
    stop = datasets.read_stop_words(spark, paths["stop_words"])
    return {"top_words": _semicolon(reviews.nested_top_words(reviews.top_words(read, stop, k=_option(paths, "k"))))}


# Orders, from files with a header row.


def order_schema(spark: SparkSession, paths: Paths) -> Outputs:
    tree = schema_text(datasets.read_inferred(spark, paths["orders"]))
    return {"schema": from_values(spark, [reports.SCHEMA_HEADER, *tree.splitlines()], "line")}


def _orders(spark: SparkSession, paths: Paths, *names: str) -> DataFrame:
    return datasets.read_table(spark, paths["orders"], datasets.ORDERS, names)


def _items(spark: SparkSession, paths: Paths, *names: str) -> DataFrame:
    return datasets.read_table(spark, paths["items"], datasets.ITEMS, names)


def _order_reviews(spark: SparkSession, paths: Paths) -> DataFrame:
    return datasets.read_table(spark, paths["order_reviews"], datasets.ORDER_REVIEWS)


def order_totals(spark: SparkSession, paths: Paths) -> Outputs:
    totals = orders.order_totals(_orders(spark, paths, "order_id", "customer_id"), _items(spark, paths, "seller_id"))
    return {"totals": reports.total_lines(totals)}


def orders_by_country(spark: SparkSession, paths: Paths) -> Outputs:
    customers = datasets.read_table(spark, paths["customers"], datasets.CUSTOMERS)
    counts = stage(orders.orders_by_country(_orders(spark, paths, "customer_id"), customers))
    table = reports.country_table(counts.orderBy(F.desc("n_orders"), "country"))
    return {"countries": reports.with_header(table, reports.COUNTRIES_HEADER)}


def orders_by_month(spark: SparkSession, paths: Paths) -> Outputs:
    counts = stage(orders.orders_by_month(_orders(spark, paths, "purchased_at")))
    table = reports.month_table(counts.orderBy("year", F.desc("month")))
    return {"months": reports.with_header(table, reports.MONTHS_HEADER)}


def review_scores(spark: SparkSession, paths: Paths) -> Outputs:
    return {"scores": _semicolon(orders.review_score_counts(_order_reviews(spark, paths)))}


def revenue_by_category(spark: SparkSession, paths: Paths) -> Outputs:
    products = datasets.read_table(spark, paths["products"], datasets.PRODUCTS)
    bought = _orders(spark, paths, "order_id", "purchased_at")
    sold = _items(spark, paths, "order_id", "product_id", "price", "freight")
    return {"revenue": _semicolon(orders.revenue_by_category(bought, sold, products, _option(paths, "year")))}


def best_selling_product(spark: SparkSession, paths: Paths) -> Outputs:
    return {"product": _semicolon(orders.best_selling_product(_items(spark, paths, "product_id")))}


def product_scores(spark: SparkSession, paths: Paths) -> Outputs:
    items = _items(spark, paths, "order_id", "product_id")
    return {"scores": _semicolon(orders.product_scores(items, _order_reviews(spark, paths)))}


def delivery_delay(spark: SparkSession, paths: Paths) -> Outputs:
    delivered, limits = _orders(spark, paths, "order_id", "delivered_at"), _items(spark, paths, "order_id", "ship_limit")
    return {"delay": _semicolon(orders.delivery_delay(delivered, limits))}


def customer_segments(spark: SparkSession, paths: Paths) -> Outputs:
    """An order is worth the price and freight of its items."""
    items = _items(spark, paths, "order_id", "price", "freight")
    values = items.groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight")).alias("order_value"))
    bought = _orders(spark, paths, "order_id", "customer_id", "purchased_at").join(values, "order_id", "left")
    segments = stage(orders.customer_segments(bought.fillna(0, ["order_value"])))
    return {"customers": _semicolon(segments), "segments": _semicolon(orders.segment_sizes(segments))}


def seller_ranking(spark: SparkSession, paths: Paths) -> Outputs:
    items = _items(spark, paths, "seller_id", "order_id", "price", "freight")
    return {"sellers": _semicolon(orders.seller_ranking(items).orderBy("seller_rank", "seller_id"))}


_PARTS = ("ratings_1", "ratings_2")

JOBS: dict[str, Job] = {
    "movie_pairs": Job(("ratings", "movies"), movie_pairs),
    "genre_pairs": Job(("ratings", "movies"), genre_pairs),
    "gender_pairs": Job(("ratings", "users", "movies"), gender_pairs),
    "age4_pairs": Job(("ratings", "users", "movies"), age4_pairs),
    "movie_lines": Job((*_PARTS, "movies"), movie_lines),
    "genre_lines": Job((*_PARTS, "movies"), genre_lines),
    "gender_lines": Job((*_PARTS, "users", "movies"), gender_lines),
    "age7_lines": Job((*_PARTS, "users", "movies"), age7_lines),
    "occupation_lines": Job((*_PARTS, "users", "occupations"), occupation_lines),
    "year_lines": Job(_PARTS, year_lines),
    "clean_words": Job(("reviews", "stop_words"), clean_words),
    "word_counts": Job(("reviews",), word_counts),
    "top_aspects": Job(("reviews",), top_aspects),
    "top_aspect": Job(("reviews",), top_aspect),
    "top_words_by_sentiment": Job(("reviews", "stop_words"), top_words_by_sentiment),
    "top_words": Job(("reviews", "stop_words"), top_words),
    "order_schema": Job(("orders",), order_schema),
    "order_totals": Job(("orders", "items"), order_totals),
    "orders_by_country": Job(("orders", "customers"), orders_by_country),
    "orders_by_month": Job(("orders",), orders_by_month),
    "review_scores": Job(("order_reviews",), review_scores),
    "revenue_by_category": Job(("orders", "items", "products"), revenue_by_category),
    "best_selling_product": Job(("items",), best_selling_product),
    "product_scores": Job(("items", "order_reviews"), product_scores),
    "delivery_delay": Job(("orders", "items"), delivery_delay),
    "customer_segments": Job(("orders", "items"), customer_segments),
    "seller_ranking": Job(("items",), seller_ranking),
}


def run(spark: SparkSession, name: str, paths: Paths, out: str) -> None:
    """Write every output of the job into its own folder under ``out``."""
    job = JOBS[name]
    missing = [i for i in job.inputs if i not in paths]
    if missing:
        raise ValueError(f"{name} needs {', '.join(missing)}")
    try:
        for output, lines in job.build(spark, paths).items():
            write_lines(lines if isinstance(lines, DataFrame) else lines(), f"{out}/{output}")
    finally:
        clean(spark)


def main(arguments: list[str]) -> int:
    if not arguments or arguments[0] not in JOBS:
        print("\n".join(f"{n}: {' '.join(f'{i}=PATH' for i in j.inputs)} out=FOLDER" for n, j in JOBS.items()))
        print("options:", *(f"{name}={value}" for name, value in OPTIONS.items()))
        return 2
    paths = dict(a.split("=", 1) for a in arguments[1:])
    spark = SparkSession.builder.appName(f"reckoner {arguments[0]}").getOrCreate()
    run(spark, arguments[0], paths, paths.pop("out"))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
