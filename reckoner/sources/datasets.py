"""Readers for the named inputs: ratings, reviews and orders."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from reckoner.operators.enrich import one_per_key
from reckoner.operators.filters import parsed_only
from reckoner.sources.csv import read_declared, read_named, read_with_header
from reckoner.sources.text import Dialect, first_field, parse_lines, read_lines

# Column order of the input files. An id is text where the program
# compares texts, and a whole number where it parses it.
MOVIES = "movie_id {id}, title string, genres string"
RATINGS = "user_id {id}, movie_id {id}, rating double, rated_at bigint"
USERS = "user_id {id}, gender string, age int, occupation_id {id}, zip_code string"
OCCUPATIONS = "occupation_id {id}, occupation string"
REVIEWS = "id bigint, review string, category string, aspect string, sentiment string"


def _rows(spark: SparkSession, path, schema: str, dialect: Dialect, columns, min_fields=None) -> DataFrame:
    """The columns asked for. Rows too short for the whole schema are dropped where the dialect drops short rows."""
    schema = schema.format(id="string" if dialect.trim else "bigint")
    if dialect.on_short_row == "drop" and min_fields is None:
        min_fields = schema.count(",") + 1
    return parse_lines(read_lines(spark, path), schema, dialect, min_fields, columns)


def read_movies(spark: SparkSession, path, dialect: Dialect, columns=None) -> DataFrame:
    return one_per_key(_rows(spark, path, MOVIES, dialect, columns), "movie_id")


def read_users(spark: SparkSession, path, dialect: Dialect, columns=None, skip_bad_age: bool = False) -> DataFrame:
    """Users, one row per id. With ``skip_bad_age`` rows whose age is no number are left out before that.

    ``columns`` limits what is parsed, so a bad number elsewhere does not fail.
    """
    if not skip_bad_age:
        return one_per_key(_rows(spark, path, USERS, dialect, columns), "user_id")
    rows = _rows(spark, path, USERS.replace("age int", "age string"), dialect, columns)
    return one_per_key(parsed_only(rows, "age", "int"), "user_id")


def read_occupations(spark: SparkSession, path, dialect: Dialect) -> DataFrame:
    return one_per_key(_rows(spark, path, OCCUPATIONS, dialect, None), "occupation_id")


def read_ratings(spark: SparkSession, path, dialect: Dialect, columns=None, min_fields: int | None = None) -> DataFrame:
    """Ratings of a file, a folder or several paths. Extra fields are ignored."""
    return _rows(spark, path, RATINGS, replace(dialect, bounded=False), columns, min_fields)


def read_reviews(spark: SparkSession, path) -> DataFrame:
    return read_declared(spark, path, REVIEWS)


def read_stop_words(spark: SparkSession, path) -> DataFrame:
    """The first tab-separated field of every line."""
    return first_field(read_lines(spark, path), "word")


# Columns of the files with a header row, and the names and types the analyses use.
ORDERS = {
    "Order_ID": ("order_id", "string"),
    "Customer_Trx_ID": ("customer_id", "string"),
    "Order_Purchase_Timestamp": ("purchased_at", "timestamp"),
    "Order_Delivered_Carrier_Date": ("delivered_at", "timestamp"),
}
CUSTOMERS = {"Customer_Trx_ID": ("customer_id", "string"), "Customer_Country": ("country", "string")}
ITEMS = {
    "Order_ID": ("order_id", "string"),
    "Product_ID": ("product_id", "string"),
    "Seller_ID": ("seller_id", "string"),
    "Shipping_Limit_Date": ("ship_limit", "timestamp"),
    "Price": ("price", "decimal(14,2)"),
    "Freight_Value": ("freight", "decimal(14,2)"),
}
PRODUCTS = {"Product_ID": ("product_id", "string"), "Product_Category_Name": ("category", "string")}
ORDER_REVIEWS = {"Order_ID": ("order_id", "string"), "Review_Score": ("score", "string")}


def read_table(spark: SparkSession, path, columns, names=None) -> DataFrame:
    """The columns of a table under the analyses' ``names`` (all by default), found by the header."""
    wanted = {old: new for old, new in columns.items() if names is None or new[0] in names}
    return read_named(spark, path, wanted)


def read_inferred(spark: SparkSession, path) -> DataFrame:
    """All columns of a file with a header row, with inferred types."""
    return read_with_header(spark, path)
