"""Analyses of orders: totals, places, months, scores, revenue and sellers.

``orders`` holds order_id, customer_id, purchased_at and, where used,
delivered_at and order_value; ``customers`` customer_id, country; ``items``
order_id, product_id, seller_id, price, freight, ship_limit; ``products``
product_id, category; ``reviews`` order_id, score (text).
Money columns are decimals, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.functions.dates import in_year
from reckoner.functions.numbers import parse_number
from reckoner.operators.aggregate import as_metrics, distinct_values, row_count
from reckoner.operators.enrich import lookup
from reckoner.operators.rank import best_one, ntile_all, rank_all
from reckoner.operators.sets import union_all


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and whether a NULL was seen.

    Delimited files declare every column nullable, so nullability is measured;
    all columns are counted in one pass.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f.name)).alias(f"__{i}") for i, f in enumerate(df.schema)],
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            (F.col(f"__{i}") < F.col("__rows")).alias("has_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*entries)))


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Rows (metric, total): orders, distinct customers and distinct sellers.

    A missing customer or seller counts as one. Orders are scanned once.
    """
    by_order = orders.agg(
        F.count(F.lit(1)).alias("orders"), distinct_values("customer_id").alias("customers")
    )
    by_item = items.agg(distinct_values("seller_id").alias("sellers"))
    return union_all([as_metrics(by_order, ["orders", "customers"]), as_metrics(by_item, ["sellers"])])


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of known customers per country, most first.

    Orders are counted per customer first, so the join sees one row per
    customer however many orders one has.
    """
    per_customer = row_count(orders, ["customer_id"], "n")
    placed = lookup(per_customer, customers.select("customer_id", "country"), "customer_id")
    counted = placed.groupBy("country").agg(F.sum("n").alias("n_orders"))
    return counted.orderBy(F.desc("n_orders"), "country")


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders per year and month of purchase, years ascending, months descending."""
    dated = orders.select(F.year("purchased_at").alias("year"), F.month("purchased_at").alias("month"))
    return row_count(dated, ["year", "month"], "n_orders").orderBy("year", F.desc("month"))


def valid_scores(reviews: DataFrame) -> DataFrame:
    """Reviews whose score is a whole number from 1 to 5."""
    score = parse_number(F.col("score"), "int", on_bad="null")
    return reviews.withColumn("score", score).filter(F.col("score").isin(1, 2, 3, 4, 5))


def review_score_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per valid score, and the mean of all valid scores next to each."""
    counts = row_count(valid_scores(reviews), ["score"], "n_reviews")
    overall = counts.agg(F.sum(F.col("score") * F.col("n_reviews")) / F.sum("n_reviews")).scalar()
    return counts.withColumn("avg_score", overall).orderBy("score")


def revenue_by_category(orders: DataFrame, items: DataFrame, products: DataFrame, year: int) -> DataFrame:
    """Price plus freight of the items ordered in ``year``, per product category."""
    bought = orders.filter(in_year(F.col("purchased_at"), year)).select("order_id")
    sold = items.join(bought, "order_id", "left_semi")
    per_product = sold.groupBy("product_id").agg(F.sum(F.col("price") + F.col("freight")).alias("amount"))
    categorised = lookup(per_product, products.select("product_id", "category"), "product_id")
    return categorised.groupBy("category").agg(F.sum("amount").alias("revenue"))


def best_selling_product(items: DataFrame) -> DataFrame:
    """The product with most items sold, the first id as text among ties."""
    return best_one(row_count(items, ["product_id"], "n_sold"), "n_sold", "product_id")


def product_scores(items: DataFrame, reviews: DataFrame, salts: int = 1) -> DataFrame:
    """Mean valid score per product over all (item, review of its order) pairs.

    Reviews are reduced per order first, so no pairs are built: an order with
    total score s over r reviews adds s and r once for each of its items. Items
    are counted per order and product, so a hot pair is one row in the join.
    """
    per_order = (
        valid_scores(reviews)
        .groupBy("order_id")
        .agg(F.sum("score").alias("order_score"), F.count(F.lit(1)).alias("order_reviews"))
    )
    bought = row_count(items, ["order_id", "product_id"], "n_items")
    scored = lookup(bought, per_order, "order_id", salts=salts)
    return (
        scored.groupBy("product_id")
        .agg(
            F.sum(F.col("order_score") * F.col("n_items")).alias("score"),
            F.sum(F.col("order_reviews") * F.col("n_items")).alias("n_scores"),
        )
        .select("product_id", (F.col("score") / F.col("n_scores")).alias("avg_score"), "n_scores")
    )


def delivery_delay(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Mean days from shipping limit to delivery, and the share of late items.

    Items with either date missing are left out.
    """
    delivered = orders.select("order_id", "delivered_at").filter(F.col("delivered_at").isNotNull())
    limits = items.select("order_id", "ship_limit").filter(F.col("ship_limit").isNotNull())
    days = lookup(limits, delivered, "order_id").select(F.datediff("delivered_at", "ship_limit").alias("days"))
    return days.agg(
        F.count("days").alias("n_items"),
        F.avg("days").alias("avg_delay_days"),
        F.avg(F.when(F.col("days") > 0, 1).otherwise(0)).alias("late_share"),
    )


def customer_measures(orders: DataFrame) -> DataFrame:
    """Orders, mean order value and orders per 30 days of every customer.

    The period runs from the first to the last order, both days included.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("order_value").alias("value"),
        (F.datediff(F.max("purchased_at"), F.min("purchased_at")) + 1).alias("days"),
    )
    return per_customer.select(
        "customer_id",
        "n_orders",
        (F.col("value").cast("double") / F.col("n_orders")).alias("avg_order_value"),
        (F.col("n_orders") * 30.0 / F.col("days")).alias("orders_per_30_days"),
    )


def _segmented(measured: DataFrame, many_orders: Column, high_value: Column, frequent: Column) -> DataFrame:
    loyal = (F.col("n_orders") >= many_orders) | (F.col("orders_per_30_days") >= frequent)
    valuable = F.col("avg_order_value") >= high_value
    segment = (
        F.when(F.col("n_orders") == 1, "one-time")
        .when(loyal & valuable, "loyal high-value")
        .when(loyal, "loyal")
        .when(valuable, "high-value")
        .otherwise("occasional")
    )
    return measured.withColumn("segment", segment)


def customer_segments(
    orders: DataFrame, many_orders: int = 10, high_value: float = 250000.0, frequent: float = 1.0
) -> DataFrame:
    """The measures of every customer, with a segment by fixed limits."""
    return _segmented(customer_measures(orders), F.lit(many_orders), F.lit(high_value), F.lit(frequent))


def customer_segments_by_share(orders: DataFrame, share: float = 0.9, accuracy: int = 100_000) -> DataFrame:
    """The measures of every customer, with a segment by the quantiles of all customers.

    A limit is the least value that ``share`` of all customers do not exceed, so
    the segments follow the data. The three limits are one scalar subquery of
    mergeable summaries; their rank is off by at most 1 / ``accuracy`` of the
    customers, and exact for fewer customers than ``accuracy``.
    """
    measured = customer_measures(orders)
    names = ("n_orders", "avg_order_value", "orders_per_30_days")
    limits = measured.agg(F.struct(*[F.percentile_approx(n, share, accuracy).alias(n) for n in names])).scalar()
    placed = measured.withColumn("limits", limits)
    return _segmented(placed, *[F.col(f"limits.{n}") for n in names]).drop("limits")


def customer_tiles(orders: DataFrame, tiles: int = 10) -> DataFrame:
    """Total value of every customer and its tile, the most valuable tenth first."""
    values = orders.groupBy("customer_id").agg(F.sum("order_value").alias("value"))
    return ntile_all(values, ["value", "customer_id"], tiles)


def segment_sizes(segments: DataFrame) -> DataFrame:
    """Customers per segment."""
    return row_count(segments, ["segment"], "n_customers")


def seller_ranking(items: DataFrame) -> DataFrame:
    """Sellers ranked by revenue, then by number of distinct orders."""
    per_order = items.groupBy("seller_id", "order_id").agg(F.sum(F.col("price") + F.col("freight")).alias("amount"))
    per_seller = per_order.groupBy("seller_id").agg(
        F.sum("amount").alias("revenue"), F.count("order_id").alias("n_orders")
    )
    return rank_all(per_seller, ["revenue", "n_orders"], "seller_rank")
