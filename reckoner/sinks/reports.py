"""Report lines, one ``line`` column each, kept apart from the numeric results.

Two styles exist: key, tab, value with means rounded half up, and fixed-width
lines with the exact binary value rounded. The order of the input is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.functions.buckets import FOUR_AGES, SEVEN_AGES
from reckoner.functions.numbers import fixed2_binary, fixed2_half_up
from reckoner.functions.text import left_text, pad_ascii, pad_text
from reckoner.sinks.writers import table_lines
from reckoner.sources.memory import from_values

# Texts of the reports. %s stands for a formatted value.
KEY_VALUE = "%s\t%s"
MOVIE_VALUE = "Diem Trung Binh: %s (Tong so luot: %d)"
CHAMPION_KEY = "=> QUAN QUAN: "
CHAMPION_VALUE = (
    "%s is the highest rated movie with an average rating of %s among movies with at least %d ratings."
)
GENRE_VALUE = "Avg: %s, Count: %d"
GENDER_VALUE = "Male: %s, Female: %s"
AGE4_VALUE = "0-18: %s   18-35: %s   35-50: %s   50+: %s"
AGE4_MISSING = "NA"
MISSING = "N/A"
MOVIE_LINE = "MovieID: %d | Title: %s | AvgRating: %s | Count: %d"
WINNER_LINE = "WINNER -> Title: '%s' | Điểm: %s | Lượt đánh giá: %d"
NO_WINNER_LINE = "Không có phim nào đạt điều kiện >= %d lượt đánh giá."
GENRE_LINE = "Genre: %s | AvgRating: %s | Total Ratings: %d"
GENDER_LINE = "MovieID: %s | %s | Male Avg: %s | Female Avg: %s"
AGE7_LINE = "ID: %s | %s | %s"
AGE7_VALUE = "%s (%d votes)"
OCCUPATION_LINE = "Occupation: %s | AvgRating: %s | Total Ratings: %d"
YEAR_LINE = "Year: %d | AvgRating: %s | Total Ratings: %d"
MOVIES_HEADER = "--- DANH SÁCH TỔNG HỢP PHIM ---"
WINNER_HEADER = "--- PHIM CÓ ĐIỂM TRUNG BÌNH CAO NHẤT (>= %d LƯỢT ĐÁNH GIÁ) ---"
GENRES_HEADER = "--- ĐIỂM TRUNG BÌNH THEO THỂ LOẠI PHIM ---"
GENDERS_HEADER = "--- DIEM TRUNG BINH THEO PHIM VA GIOI TINH ---"
AGES_HEADER = "--- ĐIỂM TRUNG BÌNH PHIM THEO NHÓM TUỔI ---"
OCCUPATIONS_HEADER = "--- ĐIỂM TRUNG BÌNH THEO NGHỀ NGHIỆP ---"
YEARS_HEADER = "--- ĐIỂM TRUNG BÌNH VÀ TỔNG LƯỢT ĐÁNH GIÁ THEO NĂM ---"
SCHEMA_HEADER = "Cấu trúc Schema:"
COUNTRIES_HEADER = "Số lượng đơn hàng theo quốc gia:"
MONTHS_HEADER = "Số lượng đơn hàng nhóm theo năm, tháng đặt hàng (Năm tăng dần, Tháng giảm dần):"
COUNTRY_COLUMNS = {"country": "Customer_Country", "n_orders": "count"}
MONTH_COLUMNS = {"year": "Year", "month": "Month", "n_orders": "count"}
TOTAL_LABELS = {
    "orders": "Tổng số đơn hàng",
    "customers": "Tổng số khách hàng",
    "sellers": "Tổng số người bán",
}


def _line(df: DataFrame, text: str, *values: Column | str) -> DataFrame:
    return df.select(F.format_string(text, *values).alias("line"))


def _or(text: Column, missing: str) -> Column:
    return F.coalesce(text, F.lit(missing))


def _half_up_or(mean: str, missing: str) -> Column:
    return _or(fixed2_half_up(F.col(mean)), missing)


# Key and value, separated by a tab.


def movie_pairs(means: DataFrame) -> DataFrame:
    """Title, then the mean at full precision and the count."""
    value = F.format_string(MOVIE_VALUE, F.col("avg_rating").cast("string"), "n_ratings")
    return _line(means, KEY_VALUE, "title", value)


def champion_pair(best: DataFrame, min_support: int = 5) -> DataFrame:
    """One line about the best movie; with no movie an empty title and 0.0."""
    row = best.agg(F.max(F.struct("avg_rating", "title")).alias("b"))
    value = F.format_string(
        CHAMPION_VALUE,
        _or(F.col("b.title"), ""),
        F.coalesce("b.avg_rating", F.lit(0.0)).cast("string"),
        F.lit(min_support),
    )
    return _line(row, KEY_VALUE, F.lit(CHAMPION_KEY), value)


def genre_pairs(means: DataFrame) -> DataFrame:
    value = F.format_string(GENRE_VALUE, fixed2_half_up(F.col("avg_rating")), "n_ratings")
    return _line(means, KEY_VALUE, "genre", value)


def gender_pairs(means: DataFrame) -> DataFrame:
    value = F.format_string(
        GENDER_VALUE, fixed2_half_up(F.col("avg_male")), fixed2_half_up(F.col("avg_female"))
    )
    return _line(means, KEY_VALUE, "title", value)


def age4_pairs(means: DataFrame) -> DataFrame:
    value = F.format_string(AGE4_VALUE, *[_half_up_or(f"avg_{b.name}", AGE4_MISSING) for b in FOUR_AGES])
    return _line(means, KEY_VALUE, "title", value)


# Fixed-width lines.


def movie_lines(means: DataFrame) -> DataFrame:
    return _line(means, MOVIE_LINE, "movie_id", "title", fixed2_binary(F.col("avg_rating")), "n_ratings")


def winner_line(best: DataFrame, min_support: int = 5) -> DataFrame:
    """One line: the best movie, or that none has enough ratings."""
    row = best.agg(F.max(F.struct("avg_rating", "title", "n_ratings")).alias("b"))
    found = F.format_string(WINNER_LINE, "b.title", fixed2_binary(F.col("b.avg_rating")), "b.n_ratings")
    return row.select(F.when(F.col("b").isNotNull(), found).otherwise(NO_WINNER_LINE % min_support).alias("line"))


def genre_lines(means: DataFrame) -> DataFrame:
    return _line(means, GENRE_LINE, pad_text(F.col("genre"), 15), fixed2_binary(F.col("avg_rating")), "n_ratings")


def gender_lines(means: DataFrame) -> DataFrame:
    male, female = (pad_ascii(_or(fixed2_binary(F.col(c)), MISSING), 5) for c in ("avg_male", "avg_female"))
    return _line(means, GENDER_LINE, pad_text(F.col("movie_id"), 5), left_text(F.col("title"), 40), male, female)


def age7_lines(means: DataFrame) -> DataFrame:
    groups = []
    for b in SEVEN_AGES:
        mean, votes = F.col(f"avg_{b.name}"), F.col(f"n_{b.name}")
        value = F.when(votes > 0, F.format_string(AGE7_VALUE, fixed2_binary(mean), votes)).otherwise(MISSING)
        groups.append(F.concat(F.lit(f"{b.label}: "), pad_ascii(value, 15)))
    return _line(
        means,
        AGE7_LINE,
        pad_text(F.col("movie_id"), 4),
        left_text(F.col("title"), 35),
        F.concat_ws(" | ", *groups),
    )


def occupation_lines(means: DataFrame) -> DataFrame:
    name = pad_text(F.col("occupation"), 20)
    return _line(means, OCCUPATION_LINE, name, fixed2_binary(F.col("avg_rating")), "n_ratings")


def year_lines(means: DataFrame) -> DataFrame:
    return _line(means, YEAR_LINE, "year", fixed2_binary(F.col("avg_rating")), "n_ratings")


def total_lines(totals: DataFrame) -> DataFrame:
    """Label and number for every metric of ``plans.orders.order_totals``."""
    label = F.create_map(*[F.lit(x) for pair in TOTAL_LABELS.items() for x in pair])[F.col("metric")]
    return totals.select(F.concat(label, F.lit(": "), F.col("total").cast("string")).alias("line"))


def _table(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    return table_lines(counts.select(*[F.col(old).alias(new) for old, new in names.items()]))


def country_table(counts: DataFrame) -> DataFrame:
    """The bordered table of all countries of ``plans.orders.orders_by_country``."""
    return _table(counts, COUNTRY_COLUMNS)


def month_table(counts: DataFrame) -> DataFrame:
    """The bordered table of all months of ``plans.orders.orders_by_month``."""
    return _table(counts, MONTH_COLUMNS)


def with_header(lines: DataFrame, header: str) -> DataFrame:
    """The header line, then all lines."""
    first = from_values(lines.sparkSession, [header], "line")
    return first.unionByName(lines)
