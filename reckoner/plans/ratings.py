"""Analyses of ratings by movie, genre, user group and year.

``ratings`` holds user_id, movie_id, rating, rated_at; ``movies`` movie_id,
title, genres; ``users`` user_id, gender, age, occupation_id; ``occupations``
occupation_id, occupation. Dimensions hold one row per key.

Ratings are aggregated to the key of a lookup before the lookup wherever the
mean allows it. The shuffle of the aggregate then serves the join as well, and
a user or movie with a third of all ratings is one row by then. Only means per
movie and user group join the ratings themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reckoner.functions.buckets import FOUR_AGES, SEVEN_AGES, Bucket, bucket
from reckoner.functions.dates import year_of_epoch
from reckoner.functions.text import drop_trailing_empty
from reckoner.operators.aggregate import conditional_means, mean_count, means_of_totals, totals
from reckoner.operators.enrich import lookup
from reckoner.operators.filters import not_empty, parsed_only, with_support
from reckoner.operators.observed import best_metrics
from reckoner.operators.rank import best_one
from reckoner.operators.sets import union_all
from reckoner.operators.tokens import explode_list

# Names given to what a lookup does not find, and gender codes.
UNTITLED = "Chua_co_ten"
UNKNOWN = "Unknown"
UNKNOWN_MOVIE = "Unknown Movie"
GENDERS = {"M": "male", "F": "female"}
GENRE_SEP = "|"


def _movie_means(ratings: DataFrame) -> DataFrame:
    return mean_count(ratings, ["movie_id"], "rating", "avg_rating", "n_ratings")


def movie_means_keep_unknown(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Mean and count per rated movie; a movie without a title gets a placeholder."""
    titles = movies.select("movie_id", "title")
    found = lookup(_movie_means(ratings), titles, "movie_id", {"title": UNTITLED})
    return found.select("movie_id", "title", "avg_rating", "n_ratings")


def movie_means_known(parts: Sequence[DataFrame], movies: DataFrame) -> DataFrame:
    """Mean and count per known movie over several rating sets together."""
    titles = movies.select("movie_id", "title")
    ratings = union_all([p.select("movie_id", "rating") for p in parts])
    return lookup(_movie_means(ratings), titles, "movie_id").select("movie_id", "title", "avg_rating", "n_ratings")


def best_movie(means: DataFrame, min_support: int = 5, positive_only: bool = False) -> DataFrame:
    """The movie with the greatest mean among those with enough ratings; ``positive_only`` leaves out means of 0."""
    eligible = with_support(means, "n_ratings", min_support)
    if positive_only:
        eligible = eligible.filter(F.col("avg_rating") > 0)
    return best_one(eligible, "avg_rating", "movie_id")


def best_movie_metrics(min_support: int = 5, positive_only: bool = False) -> dict[str, Column]:
    """``best_movie`` as aggregates over the means, to be observed while these are written."""
    eligible = F.col("n_ratings") >= min_support
    if positive_only:
        eligible &= F.col("avg_rating") > 0
    return best_metrics(["title", "avg_rating", "n_ratings"], "avg_rating", "movie_id", eligible)


def best_movie_seen(spark: SparkSession, values: Mapping[str, object]) -> DataFrame:
    """The observed ``best_movie_metrics`` as a table of one row, or of none."""
    found = [(values["title"], values["avg_rating"], values["n_ratings"])] if values["n_ratings"] is not None else []
    return spark.createDataFrame(found, "title string, avg_rating double, n_ratings bigint")


def genre_means(ratings: DataFrame, movies: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Mean and count per genre; a rating counts once for each genre of its movie.

    ``keep_empty`` keeps an empty genre, and empty genres at the end of a list.
    """
    genres = movies.select("movie_id", "genres")
    if not keep_empty:
        trimmed = genres.withColumn("genres", drop_trailing_empty(F.col("genres"), GENRE_SEP))
        genres = not_empty(trimmed, "genres")
    per_movie = lookup(totals(ratings, ["movie_id"], "rating"), genres, "movie_id")
    per_genre = explode_list(per_movie, "genres", GENRE_SEP, "genre")
    return means_of_totals(per_genre, ["genre"], "avg_rating", "n_ratings")


def gender_means_known(ratings: DataFrame, users: DataFrame, movies: DataFrame, salts: int = 1) -> DataFrame:
    """Male and female mean per known movie; a gender without ratings gets 0.0."""
    people = users.select("user_id", "gender").filter(F.col("gender").isin(*GENDERS))
    rated = lookup(ratings.select("user_id", "movie_id", "rating"), people, "user_id", salts=salts)
    means = conditional_means(rated, ["movie_id"], "gender", GENDERS, "rating", "avg_")
    titled = lookup(means, not_empty(movies.select("movie_id", "title"), "title"), "movie_id")
    return titled.select(
        "movie_id",
        "title",
        *[F.coalesce(f"avg_{g}", F.lit(0.0)).alias(f"avg_{g}") for g in GENDERS.values()],
    )


def gender_means_all(ratings: DataFrame, users: DataFrame, movies: DataFrame, salts: int = 1) -> DataFrame:
    """Male and female mean per rated movie, ordered by movie; missing means are NULL.

    Ratings by unknown users or other genders still give the movie its row.
    """
    people = users.select("user_id", "gender")
    rated = lookup(
        ratings.select("user_id", "movie_id", "rating"), people, "user_id", {"gender": UNKNOWN}, salts
    )
    means = conditional_means(rated, ["movie_id"], "gender", GENDERS, "rating", "avg_")
    titled = lookup(means, movies.select("movie_id", "title"), "movie_id", {"title": UNKNOWN_MOVIE})
    return titled.select("movie_id", "title", "avg_male", "avg_female").orderBy("movie_id")


def _names(table: Sequence[Bucket]) -> dict[str, str]:
    return {b.label: b.name for b in table}


def age4_means(ratings: DataFrame, users: DataFrame, movies: DataFrame, salts: int = 1) -> DataFrame:
    """Mean per known movie and four age groups; users whose age is no number are left out."""
    people = parsed_only(users.select("user_id", "age"), "age", "int")
    groups = people.select("user_id", bucket(F.col("age"), FOUR_AGES).alias("age_group"))
    rated = lookup(ratings.select("user_id", "movie_id", "rating"), groups, "user_id", salts=salts)
    means = conditional_means(rated, ["movie_id"], "age_group", _names(FOUR_AGES), "rating", "avg_")
    titled = lookup(means, not_empty(movies.select("movie_id", "title"), "title"), "movie_id")
    return titled.select("movie_id", "title", *[f"avg_{b.name}" for b in FOUR_AGES])


def age7_means(ratings: DataFrame, users: DataFrame, movies: DataFrame, salts: int = 1) -> DataFrame:
    """Mean and votes per rated movie and seven age groups, ordered by movie.

    Ratings by unknown users belong to no group but give the movie its row.
    """
    groups = users.select("user_id", bucket(F.col("age"), SEVEN_AGES).alias("age_group"))
    rated = lookup(
        ratings.select("user_id", "movie_id", "rating"), groups, "user_id", {"age_group": UNKNOWN}, salts
    )
    means = conditional_means(rated, ["movie_id"], "age_group", _names(SEVEN_AGES), "rating", "avg_", "n_")
    titled = lookup(means, movies.select("movie_id", "title"), "movie_id", {"title": UNKNOWN_MOVIE})
    columns = [f"{p}_{b.name}" for b in SEVEN_AGES for p in ("avg", "n")]
    return titled.select("movie_id", "title", *columns).orderBy("movie_id")


def occupation_means(ratings: DataFrame, users: DataFrame, occupations: DataFrame) -> DataFrame:
    """Mean and count per occupation name, best first; unknown users or ids are one group."""
    per_user = totals(ratings, ["user_id"], "rating")
    with_id = lookup(per_user, users.select("user_id", "occupation_id"), "user_id", {"occupation_id": -1})
    per_id = with_id.groupBy("occupation_id").agg(F.sum("total").alias("total"), F.sum("votes").alias("votes"))
    named = lookup(
        per_id, occupations.select("occupation_id", "occupation"), "occupation_id", {"occupation": UNKNOWN}
    )
    means = means_of_totals(named, ["occupation"], "avg_rating", "n_ratings")
    return means.orderBy(F.desc("avg_rating"), "occupation")


def year_means(ratings: DataFrame) -> DataFrame:
    """Mean and count per UTC calendar year, ordered by year."""
    dated = ratings.select(year_of_epoch(F.col("rated_at")).alias("year"), "rating")
    return mean_count(dated, ["year"], "rating", "avg_rating", "n_ratings").orderBy("year")


def doubled(numbers: DataFrame, column: str, name: str = "doubled") -> DataFrame:
    """Every number times two, next to the other columns."""
    return numbers.withColumn(name, F.col(column) * 2)
