"""Order, revenue, seller, delivery and customer analyses.

orders(order_id, customer_id, purchase_ts, carrier_ts), customers(customer_id, country),
items(order_id, product_id, seller_id, price, freight, shipping_limit),
reviews(order_id, score text), products(product_id, category).
Orders, customers and products are unique on their id.

Amounts are summed as whole units of `digits` decimals (`scaled`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparktally.functions.parsing import in_year, safe_int, scaled, unscaled
from sparktally.operators.aggregates import distinct_total
from sparktally.operators.distinct_sketches import distinct_sketches
from sparktally.operators.joins import lookup
from sparktally.operators.quantiles import level, quantile_cuts
from sparktally.operators.ranking import attach_rank, rank_values, top_k
from sparktally.session import ensure_checkpoint_dir


def entity_totals(orders: DataFrame, customers: DataFrame, items: DataFrame,
                  approximate: bool = False) -> DataFrame:
    """One row: total_orders, total_customers, total_sellers (distinct ids)."""
    total = lambda df, column, name: distinct_total(df, column, name, approximate)
    found = total(orders, "order_id", "total_orders")
    return found.select(
        "total_orders",
        total(customers, "customer_id", "n").scalar().alias("total_customers"),
        total(items, "seller_id", "n").scalar().alias("total_sellers"))


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """country, total_orders, most orders first; orders of unknown customers under null."""
    placed = lookup(orders.select("order_id", "customer_id"),
                    customers.select("customer_id", "country"), "customer_id", "left",
                    hot_keys=True)
    return (placed.groupBy("country").agg(F.countDistinct("order_id").alias("total_orders"))
            .orderBy(F.desc("total_orders"), F.asc("country")))


def orders_by_month(orders: DataFrame) -> DataFrame:
    """year ascending, month descending, total_orders."""
    return (orders.groupBy(F.year("purchase_ts").alias("year"), F.month("purchase_ts").alias("month"))
            .agg(F.countDistinct("order_id").alias("total_orders"))
            .orderBy(F.asc("year"), F.desc("month")))


def review_score_distribution(reviews: DataFrame, lo: int = 1, hi: int = 5) -> DataFrame:
    """score, total_reviews, avg_score for whole scores between lo and hi."""
    scored = reviews.select(safe_int(F.col("score")).alias("score"))
    # One reference to the parsed score, where a range would parse it twice.
    return (scored.where(F.col("score").isin(list(range(lo, hi + 1))))
            .groupBy("score")
            .agg(F.count(F.lit(1)).alias("total_reviews"), F.avg("score").alias("avg_score"))
            .orderBy("score"))


def review_overall(reviews: DataFrame, lo: int = 1, hi: int = 5) -> DataFrame:
    """One row: overall mean and what the cleaning left out."""
    # Reduced to one row per parsed score and kind before the kinds are told apart.
    counts = (reviews.groupBy(safe_int(F.col("score")).alias("_score"),
                              F.isnull("score").alias("_missing"))
              .agg(F.count(F.lit(1)).alias("_n")))
    score, n = F.col("_score"), F.col("_n")
    valid = score.between(lo, hi)
    total = lambda hit: F.coalesce(F.sum(F.when(hit, n)), F.lit(0))
    return counts.agg(
        total(F.lit(True)).alias("n_rows"),
        total(valid).alias("n_valid"),
        total(F.col("_missing")).alias("n_null"),
        total(~F.col("_missing") & score.isNull()).alias("n_not_numeric"),
        total(score.isNotNull() & ~valid).alias("n_out_of_range"),
        F.try_divide(F.sum(F.when(valid, score * n)), F.sum(F.when(valid, n))).alias("avg_score"))


def _revenue_units(digits: int) -> Column:
    return scaled(F.col("price") + F.col("freight"), digits)


def category_revenue(items: DataFrame, orders: DataFrame, products: DataFrame,
                     year: int = 2024, digits: int = 2) -> DataFrame:
    """category, total_revenue of one year, highest first; unknown category under null."""
    in_period = orders.where(in_year(F.col("purchase_ts"), year)).select("order_id")
    sold = lookup(items.select("order_id", "product_id", _revenue_units(digits).alias("_units")),
                  in_period, "order_id", hot_keys=True)
    per_product = sold.groupBy("product_id").agg(F.sum("_units").alias("_units"))
    named = lookup(per_product, products.select("product_id", "category"), "product_id", "left")
    return (named.groupBy("category")
            .agg(unscaled(F.sum("_units"), digits).alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), F.asc("category")))


def product_sales_and_rating(items: DataFrame, products: DataFrame, reviews: DataFrame,
                             fan_out: bool = True) -> DataFrame:
    """product_id, category, total_sold, avg_rating.

    fan_out=True   counts (item, scored review of its order) pairs, as joining
                   items to reviews would; products without a score are absent.
    fan_out=False  counts items, and each order's scores once per product.

    Reviews are reduced to (sum, count) per order first, so the pairs are
    counted without being built: an order with many items and many reviews
    costs its items, not their product.
    """
    score = reviews.select("order_id", safe_int(F.col("score")).alias("_score"))
    per_order = (score.groupBy("order_id")
                 .agg(F.sum("_score").alias("_sum"), F.count("_score").alias("_scores"))
                 .where(F.col("_scores") > 0))
    sold = items.select("order_id", "product_id")
    if fan_out:
        pairs = lookup(sold, per_order, "order_id", hot_keys=True)
        stats = (pairs.groupBy("product_id")
                 .agg(F.sum("_scores").alias("total_sold"), F.sum("_sum").alias("_sum"))
                 .withColumn("avg_rating", F.col("_sum") / F.col("total_sold")))
    else:
        per_pair = sold.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("_items"))
        pairs = lookup(per_pair, per_order, "order_id", "left", hot_keys=True)
        stats = (pairs.groupBy("product_id")
                 .agg(F.sum("_items").alias("total_sold"), F.sum("_sum").alias("_sum"),
                      F.sum("_scores").alias("_scores"))
                 .withColumn("avg_rating", F.try_divide("_sum", "_scores")))
    named = lookup(stats, products.select("product_id", "category"), "product_id", "left")
    return named.select("product_id", "category", "total_sold", "avg_rating")


def best_selling_product(items: DataFrame, products: DataFrame, reviews: DataFrame, k: int = 1,
                         fan_out: bool = True) -> DataFrame:
    """The k products with most sales."""
    stats = product_sales_and_rating(items, products, reviews, fan_out)
    return top_k(stats, [F.desc("total_sold"), F.asc("product_id")], k)


def seller_totals(items: DataFrame, digits: int = 2) -> DataFrame:
    """seller_id, revenue_units, total_orders, total_items_sold."""
    return items.groupBy("seller_id").agg(
        F.sum(_revenue_units(digits)).alias("revenue_units"),
        F.countDistinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("total_items_sold"))


def seller_ranking(items: DataFrame, k: int | None = 20, digits: int = 2) -> DataFrame:
    """seller_id, total_revenue, total_orders, total_items_sold, rank_by_revenue, rank_by_orders.

    With k, the k sellers of highest revenue; without, all of them.
    """
    totals = seller_totals(items, digits)
    order = [F.col("revenue_units").desc_nulls_last(), F.asc("seller_id")]
    # Always true, but it asks for every column of the totals: the ranks then
    # need the same shuffles of the items as the totals and share them.
    ranked_rows = totals.where((F.col("total_items_sold") > 0) | (F.col("total_orders") > 0)
                               | F.col("revenue_units").isNotNull())
    by_orders = rank_values(ranked_rows, "total_orders", "rank_by_orders")
    by_revenue = rank_values(ranked_rows, "revenue_units", "rank_by_revenue")
    ranked = attach_rank(totals, by_revenue, "revenue_units")
    ranked = attach_rank(ranked, by_orders, "total_orders")
    ranked = top_k(ranked, order, k) if k is not None else ranked.orderBy(*order)
    return ranked.select("seller_id", unscaled(F.col("revenue_units"), digits).alias("total_revenue"),
                         "total_orders", "total_items_sold", "rank_by_revenue", "rank_by_orders")


def _delays(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with the days from the shipping limit to the hand-over; null if not handed over."""
    joined = lookup(items.select("order_id", "seller_id", "shipping_limit"),
                    orders.select("order_id", "carrier_ts"), "order_id", "left", hot_keys=True)
    return joined.withColumn("delay_days", F.datediff("carrier_ts", "shipping_limit"))


def delivery_delay(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per seller: n_items, n_early, n_on_time, n_late, n_open, avg_delay_days."""
    delay = F.col("delay_days")
    return _delays(items, orders).groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(delay < 0).alias("n_early"),
        F.count_if(delay == 0).alias("n_on_time"),
        F.count_if(delay > 0).alias("n_late"),
        F.count_if(delay.isNull()).alias("n_open"),
        F.avg("delay_days").alias("avg_delay_days"))


def delivery_performance(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Over all items: performance (early, on_time, late, open), n_items, avg_delay_days."""
    delay = F.col("delay_days")
    performance = (F.when(delay.isNull(), "open").when(delay < 0, "early")
                   .when(delay == 0, "on_time").otherwise("late"))
    return (_delays(items, orders).groupBy(performance.alias("performance"))
            .agg(F.count(F.lit(1)).alias("n_items"), F.avg("delay_days").alias("avg_delay_days")))


def _cut(value: Column, points: Sequence[float]) -> Column:
    """0 for values up to the first cut point, 1 up to the second, and so on."""
    level = F.lit(len(points))
    for i, point in reversed(list(enumerate(points))):
        level = F.when(value <= point, i).otherwise(level)
    return level


def customer_profile(orders: DataFrame, items: DataFrame, digits: int = 2) -> DataFrame:
    """customer_id, n_orders, avg_order_value, orders_per_month.

    The frequency is over the calendar months from first to last order.
    """
    month = F.year("purchase_ts") * 12 + F.month("purchase_ts")
    dated = orders.select("order_id", "customer_id", month.alias("_month"))
    values = items.groupBy("order_id").agg(F.sum(_revenue_units(digits)).alias("_units"))
    per_customer = lookup(dated, values, "order_id", "left").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.coalesce(F.sum("_units"), F.lit(0)).alias("_units"),
        (F.max("_month") - F.min("_month") + 1).alias("_months"))
    return per_customer.select(
        "customer_id", "n_orders",
        (unscaled(F.col("_units"), digits) / F.col("n_orders")).alias("avg_order_value"),
        (F.col("n_orders") / F.col("_months")).alias("orders_per_month"))


def customer_segments(orders: DataFrame, items: DataFrame,
                      order_cuts: Sequence[float] = (1, 4),
                      value_cuts: Sequence[float] = (100.0, 500.0),
                      frequency_cuts: Sequence[float] = (0.1, 0.5),
                      digits: int = 2) -> DataFrame:
    """order_level, value_level, frequency_level, n_customers, avg_orders.

    Levels count from 0 and end at the given cut points, inclusive.
    """
    profile = customer_profile(orders, items, digits)
    return (profile.groupBy(
        _cut(F.col("n_orders"), order_cuts).alias("order_level"),
        _cut(F.col("avg_order_value"), value_cuts).alias("value_level"),
        _cut(F.col("orders_per_month"), frequency_cuts).alias("frequency_level"))
        .agg(F.count(F.lit(1)).alias("n_customers"), F.avg("n_orders").alias("avg_orders")))


def customer_segments_by_quantile(orders: DataFrame, items: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75),
                                  digits: int = 2) -> DataFrame:
    """As `customer_segments`, with the levels cut at exact quantiles of the customers."""
    ensure_checkpoint_dir(orders.sparkSession)
    profile = customer_profile(orders, items, digits).checkpoint()
    cut = lambda c: level(F.col(c), quantile_cuts(profile, c, shares))
    return (profile.groupBy(cut("n_orders").alias("order_level"), cut("avg_order_value").alias("value_level"),
                            cut("orders_per_month").alias("frequency_level"))
            .agg(F.count(F.lit(1)).alias("n_customers"), F.avg("n_orders").alias("avg_orders")))


def order_sketches(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """year, month, country, sketch of the order ids: what a load keeps to answer counts per any of them."""
    placed = lookup(orders.select("order_id", "customer_id", F.year("purchase_ts").alias("year"),
                                  F.month("purchase_ts").alias("month")),
                    customers.select("customer_id", "country"), "customer_id", "left", hot_keys=True)
    return distinct_sketches(placed, ["year", "month", "country"], "order_id")
