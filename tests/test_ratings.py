"""Ratings analyses on a small set holding every edge case, with values worked out by hand."""

import pytest
from helpers import rows

from reckoner.plans import ratings as plans
from reckoner.sinks import reports

RATINGS = [
    # user, movie, rating, rated_at
    (1, 10, 4.0, 1577836800),
    (2, 10, 5.0, 1577836800),
    (1, 10, 3.0, 1577836799),  # the same pair rated again counts again
    (3, 10, 2.0, 1577836800),
    (4, 10, 3.5, 1577836800),
    (2, 9, 4.0, 0),
    (99, 9, 1.0, 0),  # unknown user
    (1, 77, 2.5, 0),  # unknown movie
    (99, 77, 4.5, 0),
    (5, 8, 3.0, 0),  # movie with an empty title
]
MOVIES = [(10, "Same", "Crime|Drama"), (9, "Same", "Drama"), (8, "", ""), (7, "Unrated", "Drama")]
USERS = [
    (1, "M", 17, 1),
    (2, "F", 18, 2),
    (3, "X", 35, 1),
    (4, "F", 56, 8),  # unknown occupation
    (5, "M", 50, 2),
]
OCCUPATIONS = [(1, "Clerk"), (2, "Nurse"), (3, "Pilot")]


@pytest.fixture
def data(spark):
    return {
        "ratings": spark.createDataFrame(RATINGS, "user_id int, movie_id int, rating double, rated_at bigint"),
        "movies": spark.createDataFrame(MOVIES, "movie_id int, title string, genres string"),
        "users": spark.createDataFrame(USERS, "user_id int, gender string, age int, occupation_id int"),
        "occupations": spark.createDataFrame(OCCUPATIONS, "occupation_id int, occupation string"),
    }


def test_movie_means_keep_unknown(data):
    got = plans.movie_means_keep_unknown(data["ratings"], data["movies"])
    assert sorted(rows(got)) == [
        (8, "", 3.0, 1), (9, "Same", 2.5, 2), (10, "Same", 3.5, 5), (77, "Chua_co_ten", 3.5, 2),
    ]


def test_movie_means_known_over_two_parts(data):
    whole = data["ratings"]
    parts = [whole.filter("user_id = 1"), whole.filter("user_id <> 1")]
    got = plans.movie_means_known(parts, data["movies"])
    assert sorted(rows(got)) == [(8, "", 3.0, 1), (9, "Same", 2.5, 2), (10, "Same", 3.5, 5)]


def test_best_movie_needs_support_and_a_positive_mean(spark, data):
    means = plans.movie_means_keep_unknown(data["ratings"], data["movies"])
    assert rows(plans.best_movie(means)) == [(10, "Same", 3.5, 5)]
    assert rows(plans.best_movie(means, 6)) == []
    # 10 and 77 tie on 3.5; as text "10" comes first.
    assert rows(plans.best_movie(means, 2)) == [(10, "Same", 3.5, 5)]
    shape = "movie_id int, title string, avg_rating double, n_ratings int"
    supported = spark.createDataFrame([(1, "a", 4.9, 4), (2, "b", 4.0, 5), (3, "c", 0.0, 9)], shape)
    assert rows(plans.best_movie(supported, positive_only=True)) == [(2, "b", 4.0, 5)]
    zero = supported.filter("movie_id = 3")
    assert rows(plans.best_movie(zero, positive_only=True)) == [] and len(rows(plans.best_movie(zero))) == 1


def test_genre_means(spark, data):
    got = plans.genre_means(data["ratings"], data["movies"])
    assert sorted(rows(got)) == [("Crime", 3.5, 5), ("Drama", 22.5 / 7, 7)]
    kept = plans.genre_means(data["ratings"], data["movies"], keep_empty=True)
    assert sorted(rows(kept)) == [("", 3.0, 1), ("Crime", 3.5, 5), ("Drama", 22.5 / 7, 7)]
    trailing = spark.createDataFrame([(10, "t", "A|")], "movie_id int, title string, genres string")
    assert rows(plans.genre_means(data["ratings"], trailing)) == [("A", 3.5, 5)]
    assert sorted(rows(plans.genre_means(data["ratings"], trailing, keep_empty=True))) == [("", 3.5, 5), ("A", 3.5, 5)]


@pytest.mark.parametrize("salts", [1, 3])
def test_gender_means_known(data, salts):
    got = plans.gender_means_known(data["ratings"], data["users"], data["movies"], salts)
    assert sorted(rows(got)) == [(9, "Same", 0.0, 4.0), (10, "Same", 3.5, 4.25)]


@pytest.mark.parametrize("salts", [1, 3])
def test_gender_means_all(data, salts):
    got = plans.gender_means_all(data["ratings"], data["users"], data["movies"], salts)
    assert rows(got) == [
        (8, "", 3.0, None),
        (9, "Same", None, 4.0),
        (10, "Same", 3.5, 4.25),
        (77, "Unknown Movie", 2.5, None),
    ]


def test_age4_means_drop_ages_that_are_no_number(spark, data):
    users = data["users"].selectExpr("user_id", "if(user_id = 3, 'n/a', cast(age AS string)) AS age")
    got = plans.age4_means(data["ratings"], users, data["movies"])
    assert sorted(rows(got)) == [
        (9, "Same", 4.0, None, None, None),
        (10, "Same", 4.0, None, None, 3.5),
    ]


def test_age7_means(data):
    got = plans.age7_means(data["ratings"], data["users"], data["movies"])
    none = (None, 0)
    assert rows(got) == [
        (8, "", *none * 5, 3.0, 1, *none),
        (9, "Same", *none, 4.0, 1, *none * 5),
        (10, "Same", 3.5, 2, 5.0, 1, *none, 2.0, 1, *none * 2, 3.5, 1),
        (77, "Unknown Movie", 2.5, 1, *none * 6),
    ]


def test_occupation_means_are_sorted_best_first(data):
    got = plans.occupation_means(data["ratings"], data["users"], data["occupations"])
    assert rows(got) == [("Nurse", 4.0, 3), ("Unknown", 3.0, 3), ("Clerk", 11.5 / 4, 4)]


def test_group_counts_sum_to_all_ratings(data):
    occupations = plans.occupation_means(data["ratings"], data["users"], data["occupations"])
    years = plans.year_means(data["ratings"])
    for result in (occupations, years):
        assert sum(r.n_ratings for r in result.collect()) == len(RATINGS)


def test_year_means(data):
    assert rows(plans.year_means(data["ratings"])) == [(1970, 3.0, 5), (2019, 3.0, 1), (2020, 3.625, 4)]


def test_doubled(spark):
    df = spark.createDataFrame([(1,), (5,)], "n int")
    assert rows(plans.doubled(df, "n")) == [(1, 2), (5, 10)]


def _lines(df):
    return [r.line for r in df.collect()]


def test_key_value_reports(spark, data):
    means = plans.movie_means_keep_unknown(data["ratings"], data["movies"])
    assert "Same\tDiem Trung Binh: 3.5 (Tong so luot: 5)" in _lines(reports.movie_pairs(means))
    assert _lines(reports.champion_pair(plans.best_movie(means))) == [
        "=> QUAN QUAN: \tSame is the highest rated movie with an average rating of 3.5"
        " among movies with at least 5 ratings."
    ]
    assert _lines(reports.champion_pair(plans.best_movie(means, 6), 6)) == [
        "=> QUAN QUAN: \t is the highest rated movie with an average rating of 0.0"
        " among movies with at least 6 ratings."
    ]
    genres = spark.createDataFrame([("Crime", 3.775, 20)], "genre string, avg_rating double, n_ratings int")
    assert _lines(reports.genre_pairs(genres)) == ["Crime\tAvg: 3.78, Count: 20"]
    genders = plans.gender_means_known(data["ratings"], data["users"], data["movies"])
    assert sorted(_lines(reports.gender_pairs(genders))) == [
        "Same\tMale: 0.00, Female: 4.00",
        "Same\tMale: 3.50, Female: 4.25",
    ]
    ages = plans.age4_means(data["ratings"], data["users"], data["movies"])
    assert sorted(_lines(reports.age4_pairs(ages))) == [
        "Same\t0-18: 4.00   18-35: 2.00   35-50: NA   50+: 3.50",
        "Same\t0-18: 4.00   18-35: NA   35-50: NA   50+: NA",
    ]


def test_fixed_width_reports(spark, data):
    means = plans.movie_means_known([data["ratings"]], data["movies"])
    assert "MovieID: 10 | Title: Same | AvgRating: 3.50 | Count: 5" in _lines(reports.movie_lines(means))
    assert _lines(reports.winner_line(plans.best_movie(means))) == [
        "WINNER -> Title: 'Same' | Điểm: 3.50 | Lượt đánh giá: 5"
    ]
    assert _lines(reports.winner_line(plans.best_movie(means, 50), 50)) == [
        "Không có phim nào đạt điều kiện >= 50 lượt đánh giá."
    ]
    genres = spark.createDataFrame([("Crime", 3.775, 20)], "genre string, avg_rating double, n_ratings int")
    assert _lines(reports.genre_lines(genres)) == ["Genre: Crime           | AvgRating: 3.77 | Total Ratings: 20"]
    genders = plans.gender_means_all(data["ratings"], data["users"], data["movies"])
    assert _lines(reports.gender_lines(genders))[1] == (
        "MovieID: 9     | Same                                     | Male Avg: N/A   | Female Avg: 4.00 "
    )
    ages = plans.age7_means(data["ratings"], data["users"], data["movies"])
    assert _lines(reports.age7_lines(ages))[1] == (
        "ID: 9    | Same                                | <18: N/A             | 18-24: 4.00 (1 votes) "
        " | 25-34: N/A             | 35-44: N/A             | 45-49: N/A             | 50-55: N/A            "
        " | 56+: N/A            "
    )
    occupations = plans.occupation_means(data["ratings"], data["users"], data["occupations"])
    assert _lines(reports.occupation_lines(occupations))[0] == (
        "Occupation: Nurse                | AvgRating: 4.00 | Total Ratings: 3"
    )
    years = reports.year_lines(plans.year_means(data["ratings"]))
    assert _lines(reports.with_header(years, reports.YEARS_HEADER)) == [
        "--- ĐIỂM TRUNG BÌNH VÀ TỔNG LƯỢT ĐÁNH GIÁ THEO NĂM ---",
        "Year: 1970 | AvgRating: 3.00 | Total Ratings: 5",
        "Year: 2019 | AvgRating: 3.00 | Total Ratings: 1",
        "Year: 2020 | AvgRating: 3.62 | Total Ratings: 4",
    ]


def test_long_titles_are_cut(spark):
    title = "A Very Long Invented Title: Part the First of Several (1999)"
    means = spark.createDataFrame(
        [(1037, title, 4.0, None)], "movie_id int, title string, avg_male double, avg_female double"
    )
    assert _lines(reports.gender_lines(means)) == [
        "MovieID: 1037  | A Very Long Invented Title: Part the Fir | Male Avg: 4.00  | Female Avg: N/A  "
    ]
