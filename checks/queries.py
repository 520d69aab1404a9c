"""Every registered query: a function of (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.star import Star
from reckoner.functions.buckets import FOUR_AGES, SEVEN_AGES, bucket
from reckoner.functions.numbers import fixed2_binary, fixed2_half_up
from reckoner.operators import distinct
from reckoner.operators.enrich import lookup, one_per_key
from reckoner.operators.filters import parsed_only
from reckoner.operators.observed import SideResults
from reckoner.operators.partials import Partials
from reckoner.operators.rank import by_text_key
from reckoner.operators.sets import union_all
from reckoner.operators.skew import hot_keys, lookup_skewed
from reckoner.operators.tokens import explode_list
from reckoner.plans import orders, ratings, reviews
from reckoner.sinks import reports
from reckoner.sinks.writers import delimited_lines, write_lines
from reckoner.sources.bags import parse_bags
from reckoner.sources.quarantine import parse_apart
from reckoner.sources.staging import new_folder, stage_by_key
from reckoner.sources.text import Dialect, first_field, parse_declared, parse_lines

Query = Callable[[SparkSession, str], DataFrame]

MIN_SUPPORT = 30  # about half of the parts have as many line items
REVENUE_YEAR = 1998


def _on_star(build: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: build(Star(spark, folder))


# Ratings


def movie_avg_outer(s: Star) -> DataFrame:
    return ratings.movie_means_keep_unknown(s.ratings(), s.movies())


def movie_avg_inner(s: Star) -> DataFrame:
    return ratings.movie_means_known(s.rating_parts(), s.movies())


def best_movie(s: Star) -> DataFrame:
    return ratings.best_movie(movie_avg_outer(s), MIN_SUPPORT, positive_only=True)


def best_movie_of_zeros(s: Star) -> DataFrame:
    """All ratings are 0: a movie still wins where means of 0 count."""
    zeros = s.ratings().withColumn("rating", F.col("rating") * 0)
    return ratings.best_movie(ratings.movie_means_keep_unknown(zeros, s.movies()), MIN_SUPPORT)


def genre_avg(s: Star) -> DataFrame:
    return ratings.genre_means(s.ratings(), s.movies())


def gender_avg_zero(s: Star) -> DataFrame:
    return ratings.gender_means_known(s.ratings(), s.all_users(), s.movies())


def gender_avg_null(s: Star) -> DataFrame:
    return ratings.gender_means_all(s.ratings(), s.users(), s.movies())


def age4_avg(s: Star) -> DataFrame:
    return ratings.age4_means(s.ratings(), s.users_text_age(), s.movies())


def age7_avg(s: Star) -> DataFrame:
    return ratings.age7_means(s.ratings(), s.users(), s.movies())


def occupation_avg(s: Star) -> DataFrame:
    return ratings.occupation_means(s.customer_ratings(), s.members(), s.occupations())


def year_avg(s: Star) -> DataFrame:
    return ratings.year_means(s.ratings())


def double(s: Star) -> DataFrame:
    items = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ratings.doubled(items, "l_quantity")


# Reviews


def top_words_all(s: Star) -> DataFrame:
    return reviews.top_words(s.plain_reviews(), s.stop_words())


def top_words_of(sentiment: str) -> Callable[[Star], DataFrame]:
    return lambda s: reviews.top_words(s.reviews(), s.stop_words(), sentiment=sentiment)


def reviews_by(column: str) -> Callable[[Star], DataFrame]:
    return lambda s: reviews.reviews_by(s.plain_reviews(), column)


# Operators on their own


def scan_trimmed_drop_short(s: Star) -> DataFrame:
    """Comma lines with blanks; customers in debt lack the last field and are dropped."""
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    lines = s.table("customer").select(F.concat_ws(",  ", "c_custkey", "c_name", segment).alias("value"))
    return parse_lines(
        lines, "c_custkey bigint, c_name string, c_mktsegment string", Dialect(trim=True, on_short_row="drop")
    )


def scan_needed_fields_only(s: Star) -> DataFrame:
    """Customers in debt lack the last field, and all have a bad number in the second; neither is read."""
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    lines = s.table("customer").select(F.concat_ws(",", "c_custkey", F.lit("n/a"), "c_name", segment).alias("value"))
    schema = "c_custkey bigint, number int, c_name string, c_mktsegment string"
    return parse_lines(lines, schema, Dialect(), columns=["c_custkey", "c_name"])


def scan_text_ids(s: Star) -> DataFrame:
    """Ids that are no numbers, and ids beyond 32 bits as numbers."""
    big = F.col("c_custkey") + 3_000_000_000
    lines = s.table("customer").select(F.concat_ws(", ", F.concat(F.lit("M"), "c_custkey"), big, "c_name").alias("value"))
    return parse_lines(lines, "id string, number bigint, c_name string", Dialect(trim=True))


def dim_parsed_then_one_per_key(s: Star) -> DataFrame:
    """Every user twice, once with an age that is no number."""
    users = s.all_users().select("user_id", F.col("age").cast("string").alias("age"))
    bad = users.withColumn("age", F.lit("n/a"))
    return one_per_key(parsed_only(users.unionAll(bad), "age", "int"), "user_id")


def scan_short_row_null(s: Star) -> DataFrame:
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    lines = s.table("customer").select(F.concat_ws(",", "c_custkey", "c_name", segment).alias("value"))
    return parse_lines(lines, "c_custkey bigint, c_name string, c_mktsegment string", Dialect(on_short_row="null"))


def scan_bounded_last_field(s: Star) -> DataFrame:
    """Whole texts, commas included, survive as the last field."""
    lines = s.table("documents").select(F.concat_ws(",", "doc_id", "lang", "text").alias("value"))
    return parse_lines(lines, "doc_id bigint, lang string, text string", Dialect(bounded=True))


def scan_first_field(s: Star) -> DataFrame:
    lines = s.table("customer").select(F.concat_ws("\t", "c_name", "c_mktsegment").alias("value"))
    return first_field(lines, "c_name")


def scan_declared_no_quotes(s: Star) -> DataFrame:
    """Semicolon lines whose fields hold quotes; the type name is no number."""
    lines = s.table("events").select(
        F.concat_ws(";", "event_id", "props", "event_type", "event_type").alias("value")
    )
    return parse_declared(lines, "event_id bigint, props string, event_type string, bad_number int")


def lookup_salted(s: Star) -> DataFrame:
    rated = s.ratings().select("user_id", "movie_id", "rating")
    people = s.users().select("user_id", "gender")
    found = lookup(rated, people, "user_id", {"gender": ratings.UNKNOWN}, salts=4)
    return found.groupBy("gender").agg(F.count("*").alias("n"), F.sum("rating").alias("total"))


def lookup_hot_keys(s: Star) -> DataFrame:
    people = s.users().select("user_id", "gender")
    found = lookup_skewed(s.ratings_of_a_hot_user(), people, "user_id", {"gender": ratings.UNKNOWN})
    return found.groupBy("gender").agg(F.count("*").alias("n"), F.sum("rating").alias("total"))


def hot_user(s: Star) -> DataFrame:
    return hot_keys(s.ratings_of_a_hot_user(), "user_id", 0.2).select("user_id")


def movie_avg_from_partials(s: Star) -> DataFrame:
    """Two files into a new state, the first twice, then folded."""
    state = Partials(s.spark, new_folder(s.spark, "partials"), ["movie_id"], "rating", "movie_id bigint, total double")
    items, sizes = s.rating_parts()
    for batch, part in (("items", items), ("sizes", sizes), ("items", items)):
        state.add(part, batch)
    state.fold(["items", "sizes"], "both")
    return state.means("avg_rating", "n_ratings")


def best_movie_seen(s: Star) -> DataFrame:
    """The best movie and the numbers of movies with and without a title, known when all lines are written."""
    counts = {"n_movies": F.count("*"), "n_untitled": F.count(F.when(F.col("title") == ratings.UNTITLED, 1))}
    side = SideResults(ratings.best_movie_metrics(MIN_SUPPORT, positive_only=True) | counts)
    write_lines(reports.movie_pairs(side.watch(by_text_key(movie_avg_outer(s), "movie_id"))), new_folder(s.spark, "observed"))
    values = side.values()
    best = ratings.best_movie_seen(s.spark, values)
    return best.select("*", *[F.lit(values[c]).cast("bigint").alias(c) for c in counts])


def staged_by_order(s: Star) -> tuple[DataFrame, DataFrame]:
    """Orders and items, both staged by order."""
    delivered = s.orders().select("order_id", "customer_id", "delivered_at")
    shipped = s.items().select("order_id", "seller_id", "ship_limit")
    return stage_by_key(delivered, ["order_id"]), stage_by_key(shipped, ["order_id"])


def delivery_delay_of_staged(s: Star) -> DataFrame:
    return orders.delivery_delay(*staged_by_order(s))


LINE_SCHEMA = "user_id bigint, movie_id bigint, rating int"


def lines_apart(s: Star) -> tuple[DataFrame, DataFrame]:
    return parse_apart(s.rating_lines(), LINE_SCHEMA, Dialect(trim=True), ["user_id"])


def age_buckets(s: Star) -> DataFrame:
    labels = s.all_users().select(
        bucket(F.col("age"), FOUR_AGES).alias("four"), bucket(F.col("age"), SEVEN_AGES).alias("seven")
    )
    return labels.groupBy("four", "seven").agg(F.count("*").alias("n"))


def union_all_parts(s: Star) -> DataFrame:
    return union_all(s.rating_parts())


def distinct_pairs(s: Star) -> DataFrame:
    return s.table("lineitem").select("l_suppkey", "l_returnflag").distinct()


def explode_genres(s: Star) -> DataFrame:
    return explode_list(s.all_movies().select("movie_id", "genres"), "genres", "|", "genre")


def two_decimals(s: Star) -> DataFrame:
    tax = F.col("l_extendedprice") * F.col("l_discount")
    return s.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fixed2_binary(tax).alias("binary_text"),
        fixed2_half_up(F.col("l_quantity") / 8).alias("half_up_text"),
    )


def key_value_lines(s: Star) -> DataFrame:
    return delimited_lines(reviews.reviews_by(s.plain_reviews(), "category"), "\t")


def semicolon_lines(s: Star) -> DataFrame:
    return delimited_lines(reviews.word_frequency(s.plain_reviews()), ";")


def nested_bag_lines(s: Star) -> DataFrame:
    return delimited_lines(reviews.nested_top_words(top_words_all(s)), ";")


BAG_SCHEMA = "aspect string, word string, n bigint"


def nested_bag_read_back(s: Star) -> DataFrame:
    """The written bags, read again, a row per word; lines that cannot be read for sure have a reason instead."""
    read = parse_bags(nested_bag_lines(s), "category", "words", BAG_SCHEMA)
    return read.select("category", "reason", F.explode_outer("words").alias("w")).select("category", "reason", "w.word", "w.n")


def totals_from_sketches(s: Star) -> DataFrame:
    """Distinct customers and sellers, exact, and whether sketches merged over months stay within their error."""
    bought = s.orders().withColumn("month", F.date_trunc("month", "purchased_at"))
    shipped = s.items().withColumn("month", F.date_trunc("month", "ship_limit"))
    exact = orders.order_totals(s.orders(), s.items()).filter("metric <> 'orders'")
    parts = [
        distinct.sketches(bought, ["month"], "customer_id").withColumn("metric", F.lit("customers")),
        distinct.sketches(shipped, ["month"], "seller_id").withColumn("metric", F.lit("sellers")),
    ]
    sketched = distinct.estimates(distinct.merged(union_all([p.select("metric", "sketch", "has_null") for p in parts]), ["metric"]), "sketched")
    within = F.abs(F.col("sketched") - F.col("total")) <= F.ceil(F.col("total") * distinct.error_bound())
    return exact.join(sketched, "metric").select("metric", "total", within.alias("within_bound"))


_BUILDERS: dict[str, Callable[[Star], DataFrame]] = {
    # Ratings
    "q_movie_avg_outer": movie_avg_outer,
    "q_movie_avg_inner": movie_avg_inner,
    "q_best_movie": best_movie,
    "q_best_movie_of_zeros": best_movie_of_zeros,
    "q_genre_avg": genre_avg,
    "q_gender_avg_zero": gender_avg_zero,
    "q_gender_avg_null": gender_avg_null,
    "q_age4_avg": age4_avg,
    "q_age7_avg": age7_avg,
    "q_occupation_avg": occupation_avg,
    "q_year_avg": year_avg,
    "q_double": double,
    # Reviews
    "q_clean_words": lambda s: reviews.clean_words(s.plain_reviews(), s.stop_words()),
    "q_word_count": lambda s: reviews.word_frequency(s.plain_reviews()),
    "q_word_count_over": lambda s: reviews.frequent_words(s.plain_reviews(), 500),
    "q_reviews_by_category": reviews_by("category"),
    "q_reviews_by_aspect": reviews_by("aspect"),
    "q_top_negative_aspect": lambda s: reviews.top_aspects(s.reviews(), "negative"),
    "q_top_positive_aspect": lambda s: reviews.top_aspects(s.reviews(), "positive"),
    "q_top_negative_aspect_limit1": lambda s: reviews.top_aspect(s.reviews(), "negative"),
    "q_top_positive_aspect_limit1": lambda s: reviews.top_aspect(s.reviews(), "positive"),
    "q_top5_positive_words": top_words_of("positive"),
    "q_top5_negative_words": top_words_of("negative"),
    "q_top5_words": top_words_all,
    # Orders
    "q_schema_report": lambda s: orders.schema_report(s.table("orders")),
    "q_totals": lambda s: orders.order_totals(s.orders(), s.items()),
    "q_orders_by_country": lambda s: orders.orders_by_country(s.orders(), s.customers()),
    "q_orders_by_month": lambda s: orders.orders_by_month(s.orders()),
    "q_review_scores": lambda s: orders.review_score_counts(s.order_reviews()),
    "q_revenue_by_category": lambda s: orders.revenue_by_category(
        s.orders(), s.items(), s.products(), REVENUE_YEAR
    ).withColumn("revenue", F.col("revenue").cast("double")),
    "q_best_selling_product": lambda s: orders.best_selling_product(s.items()),
    "q_product_scores": lambda s: orders.product_scores(s.items(), s.order_reviews()),
    "q_delivery_delay": lambda s: orders.delivery_delay(s.orders(), s.items()),
    "q_customer_segments": lambda s: orders.customer_segments(s.orders()),
    "q_segment_sizes": lambda s: orders.segment_sizes(orders.customer_segments(s.orders())),
    "q_segments_by_share": lambda s: orders.customer_segments_by_share(s.orders()),
    "q_customer_tiles": lambda s: orders.customer_tiles(s.orders()).withColumn("value", F.col("value").cast("double")),
    "q_seller_ranking": lambda s: orders.seller_ranking(s.items()).withColumn(
        "revenue", F.col("revenue").cast("double")
    ),
    # Report lines
    "report_movie_pairs": lambda s: reports.movie_pairs(by_text_key(movie_avg_outer(s), "movie_id")),
    "report_champion_pair": lambda s: reports.champion_pair(best_movie(s), MIN_SUPPORT),
    "report_no_champion_pair": lambda s: reports.champion_pair(
        ratings.best_movie(movie_avg_outer(s), 10**9), 10**9
    ),
    "report_genre_pairs": lambda s: reports.genre_pairs(genre_avg(s)),
    "report_gender_pairs": lambda s: reports.gender_pairs(by_text_key(gender_avg_zero(s), "movie_id")),
    "report_age4_pairs": lambda s: reports.age4_pairs(by_text_key(age4_avg(s), "movie_id")),
    "report_movie_lines": lambda s: reports.movie_lines(movie_avg_inner(s)),
    "report_winner_line": lambda s: reports.winner_line(
        ratings.best_movie(movie_avg_inner(s), MIN_SUPPORT), MIN_SUPPORT
    ),
    "report_no_winner_line": lambda s: reports.winner_line(ratings.best_movie(movie_avg_inner(s), 10**9), 10**9),
    "report_country_table": lambda s: reports.country_table(orders.orders_by_country(s.orders(), s.customers())),
    "report_month_table": lambda s: reports.month_table(orders.orders_by_month(s.orders())),
    "report_genre_lines": lambda s: reports.genre_lines(genre_avg(s)),
    "report_gender_lines": lambda s: reports.gender_lines(gender_avg_null(s)),
    "report_age7_lines": lambda s: reports.age7_lines(age7_avg(s)),
    "report_occupation_lines": lambda s: reports.occupation_lines(occupation_avg(s)),
    "report_year_lines": lambda s: reports.year_lines(year_avg(s)),
    "report_total_lines": lambda s: reports.total_lines(orders.order_totals(s.orders(), s.items())),
    # Operators on their own
    "scan_trimmed_drop_short": scan_trimmed_drop_short,
    "scan_needed_fields_only": scan_needed_fields_only,
    "scan_text_ids": scan_text_ids,
    "dim_parsed_then_one_per_key": dim_parsed_then_one_per_key,
    "scan_short_row_null": scan_short_row_null,
    "scan_bounded_last_field": scan_bounded_last_field,
    "scan_first_field": scan_first_field,
    "scan_declared_no_quotes": scan_declared_no_quotes,
    "lookup_salted": lookup_salted,
    "lookup_hot_keys": lookup_hot_keys,
    "hot_user": hot_user,
    "scan_good_rows": lambda s: lines_apart(s)[0],
    "scan_quarantined_rows": lambda s: lines_apart(s)[1],
    "q_movie_avg_from_partials": movie_avg_from_partials,
    "best_movie_seen": best_movie_seen,
    "delivery_delay_of_staged": delivery_delay_of_staged,
    "age_buckets": age_buckets,
    "union_all_parts": union_all_parts,
    "distinct_pairs": distinct_pairs,
    "explode_genres": explode_genres,
    "two_decimals": two_decimals,
    "key_value_lines": key_value_lines,
    "semicolon_lines": semicolon_lines,
    "nested_bag_lines": nested_bag_lines,
    "nested_bag_read_back": nested_bag_read_back,
    "q_totals_from_sketches": totals_from_sketches,
}

QUERIES: dict[str, Query] = {name: _on_star(build) for name, build in _BUILDERS.items()}
