"""The given tables, seen as ratings, reviews and orders.

Ratings are line items: the order is the user, the part the movie and the
quantity the rating. Some dimension rows get another key, so that their facts
find nothing (parts above size 40, nations of region 4, orders of priority 5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reckoner.sources.memory import from_values

# The stop words of the checks, with a repeat and a two-word entry.
STOP_WORDS = ["the", "and", "of", "is", "de", "la", "le", "un", "und", "die", "el", "en", "the", "of the"]


def shifted(key: str, condition: Column) -> Column:
    """The key, or where the condition holds one that no fact has."""
    return F.when(condition, -1 - F.col(key)).otherwise(F.col(key))


class Star:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Ratings

    def ratings(self) -> DataFrame:
        shipped = F.col("l_shipdate")
        epoch = (
            F.unix_date(F.to_date(shipped)).cast("bigint") * 86400
            + F.hour(shipped) * 3600
            + F.minute(shipped) * 60
            + F.second(shipped)
        )
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("user_id"),
            F.col("l_partkey").alias("movie_id"),
            F.col("l_quantity").alias("rating"),
            epoch.alias("rated_at"),
        )

    def ratings_of_a_hot_user(self) -> DataFrame:
        """One user gave a third of all ratings, and none of another ninth names its user."""
        part = F.col("user_id") % 9
        user = F.when(part < 3, 1).when(part > 3, F.col("user_id"))
        return self.ratings().withColumn("user_id", user.cast("bigint")).select("user_id", "movie_id", "rating")

    def rating_lines(self) -> DataFrame:
        """Line items as lines: those of number 5 lack a field, 6 a number, 7 the user."""
        number = F.col("l_linenumber")
        user = F.when(number == 7, "").otherwise(F.col("l_orderkey").cast("string"))
        rating = F.when(number == 6, "n/a").when(number != 5, F.col("l_suppkey").cast("string"))
        return self.table("lineitem").select(F.concat_ws(", ", user, F.col("l_partkey").cast("string"), rating).alias("value"), F.col("l_returnflag").alias("file"))

    def rating_parts(self) -> list[DataFrame]:
        """Two sets, as if read from two files: line items, and the size of every part as one more rating."""
        sizes = self.table("part").select(
            F.col("p_partkey").alias("movie_id"), F.col("p_size").cast("double").alias("rating")
        )
        return [self.ratings().select("movie_id", "rating"), sizes]

    def customer_ratings(self) -> DataFrame:
        items = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return items.join(orders, "o_orderkey").select(
            F.col("o_custkey").alias("user_id"), F.col("l_quantity").alias("rating")
        )

    def all_movies(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("movie_id"),
            F.col("p_name").alias("title"),
            F.concat_ws("|", "p_type", "p_brand").alias("genres"),
            "p_size",
        )

    def movies(self) -> DataFrame:
        """All parts, those above size 40 under other keys, so that some rated movies are unknown."""
        return self.all_movies().withColumn("movie_id", shifted("movie_id", F.col("p_size") > 40))

    def all_users(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("user_id"),
            F.when(status == "F", "F").when(status == "O", "M").otherwise("other").alias("gender"),
            F.pmod("o_custkey", F.lit(80)).cast("int").alias("age"),
            "o_orderpriority",
        )

    def users(self) -> DataFrame:
        """All orders, those of priority 5 under other keys, so that some raters are unknown."""
        return self.all_users().withColumn("user_id", shifted("user_id", F.col("o_orderpriority") == "5-LOW"))

    def users_text_age(self) -> DataFrame:
        """Ages as text, not numeric for orders of priority 4."""
        unstated = F.col("o_orderpriority") == "4-NOT SPECIFIED"
        return self.all_users().withColumn("age", F.when(unstated, "n/a").otherwise(F.col("age").cast("string")))

    def members(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("occupation_id")
        )

    def occupations(self) -> DataFrame:
        """All nations, those of region 4 under other keys, so that some occupation ids are unknown."""
        key = shifted("n_nationkey", F.col("n_regionkey") == 4)
        return self.table("nation").select(key.alias("occupation_id"), F.col("n_name").alias("occupation"))

    # Reviews

    def reviews(self) -> DataFrame:
        labels = self.table("labels").select("doc_id", "quality")
        sentiment = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
        return (
            self.table("documents")
            .join(labels, "doc_id", "left")
            .select(
                F.col("doc_id").alias("id"),
                F.col("text").alias("review"),
                F.col("lang").alias("category"),
                F.col("source").alias("aspect"),
                F.coalesce(sentiment, F.lit("neutral")).alias("sentiment"),
            )
        )

    def plain_reviews(self) -> DataFrame:
        """Reviews without their sentiment, which needs a join."""
        return self.table("documents").select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("review"),
            F.col("lang").alias("category"),
            F.col("source").alias("aspect"),
        )

    def stop_words(self) -> DataFrame:
        return from_values(self.spark, STOP_WORDS, "word")

    # Orders

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("purchased_at"),
            F.col("o_orderdate").alias("delivered_at"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("order_value"),
        )

    def customers(self) -> DataFrame:
        nations = self.table("nation").select("n_nationkey", "n_name")
        customers = self.table("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
        return customers.join(nations, "n_nationkey").select(
            F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country")
        )

    def items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
            F.col("l_tax").cast("decimal(12,2)").alias("freight"),
            F.col("l_shipdate").alias("ship_limit"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))

    def order_reviews(self) -> DataFrame:
        """Events as reviews of the order with their number; scores lie outside 1 to 5 too."""
        return self.table("events").select(
            F.col("event_id").alias("order_id"), F.get_json_object("props", "$.k").alias("score")
        )
