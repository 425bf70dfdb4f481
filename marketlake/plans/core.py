"""Core dimensional models: four dimensions, four facts, one intermediate.

All functions are lazy DataFrame -> DataFrame transforms.  Joins are written
as plain equi-joins; adaptive execution measures each build side at run time
and broadcasts it only when it is actually small (otherwise sort-merge with
skewed partitions split), so no dimension is assumed to fit in memory.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.expressions import (
    CANCELED_STATUSES, DELIVERY_STATUSES, days_between, exact_avg, money_sum, surrogate_key,
)


# --------------------------------------------------------------------------- dimensions

def _with_coordinates(df: DataFrame, geo: DataFrame) -> DataFrame:
    # stg_geolocation is unique per zip_code_prefix (row_number dedup), so the
    # lookup cannot fan out and needs no defensive distinct.
    points = geo.select("zip_code_prefix", "latitude", "longitude")
    return df.join(points, "zip_code_prefix", "left")


def dim_customers(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """M1: customer_key grain with coordinates (null when the zip is unknown)."""
    return _with_coordinates(customers, geo).select(
        "customer_key", "customer_unique_id", "zip_code_prefix", "city", "state",
        "latitude", "longitude")


def dim_sellers(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """M4: seller_key grain with coordinates."""
    return _with_coordinates(sellers, geo).select(
        "seller_key", "zip_code_prefix", "city", "state", "latitude", "longitude")


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """M3: English category name, else the Portuguese one, else 'Uncategorized'."""
    names = translation.select("category_name_portuguese", "category_name_english")
    return products.join(names, "category_name_portuguese", "left").select(
        "product_key",
        F.coalesce("category_name_english", "category_name_portuguese",
                   F.lit("Uncategorized")).alias("category_name"),
        "category_name_portuguese", "name_char_length", "description_char_length",
        "photo_count", "weight_grams", "length_cm", "height_cm", "width_cm")


def fixed_bounds(spark: SparkSession, start: str | date = "2016-01-01",
                 end: str | date = "2020-12-31") -> DataFrame:
    """One-row frame (start_date, end_date) with literal calendar bounds."""
    return spark.range(1).select(F.to_date(F.lit(str(start))).alias("start_date"),
                                 F.to_date(F.lit(str(end))).alias("end_date"))


def data_bounds(orders: DataFrame) -> DataFrame:
    """One-row frame spanning the whole years of all purchases and estimated
    deliveries (a partial aggregate over the orders, no collect)."""
    bought, due = "purchase_timestamp", "estimated_delivery_timestamp"
    return orders.agg(
        F.trunc(F.to_date(F.least(F.min(bought), F.min(due))), "year").alias("start_date"),
        F.last_day(F.make_date(F.year(F.greatest(F.max(bought), F.max(due))),
                               F.lit(12), F.lit(1))).alias("end_date"))


def dim_dates(bounds: DataFrame) -> DataFrame:
    """M2: one row per day between the bounds (inclusive)."""
    d = F.col("date_key")
    days = bounds.select(F.explode(F.sequence("start_date", "end_date",
                                              F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    return days.select(
        d,
        F.year(d).alias("calendar_year"),
        F.month(d).alias("calendar_month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("calendar_quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"),
                 F.year(d).cast("string")).alias("quarter_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


# --------------------------------------------------------------------------- facts

def fct_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """M5: order-line grain; lines without an order are dropped (inner join)."""
    o = orders.select("order_key", "customer_key", "order_status",
                      F.col("purchase_timestamp").alias("ordered_at"))
    return items.join(o, "order_key", "inner").select(
        "order_key", "order_item_id", "customer_key", "product_key", "seller_key",
        "order_status", "ordered_at", "shipping_limit_timestamp", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"))


def fct_order_payments(payments: DataFrame) -> DataFrame:
    """M6: payment grain with an md5 surrogate key over (order, sequence)."""
    return payments.select(
        surrogate_key("order_key", "payment_sequential").alias("order_payment_key"),
        "order_key",
        F.col("payment_sequential").alias("payment_sequence"),
        "payment_type",
        F.col("payment_installments").alias("installment_count"),
        F.col("payment_value").alias("payment_amount"))


def fct_order_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """M7: review grain with the buyer and the answer delay in days.

    Messages are by far the widest column, so they are not dealt by order_key: the buyers of (review_key, order_key) pairs are
    looked up first and then joined where staging's deduplication has left the reviews, by review_key.  Comparing the
    order_key by range keeps it out of the join's keys, which would deal the reviews anew.  Reviews without a key are joined by order_key.
    """
    o = orders.select("order_key", "customer_key")
    keyed = reviews.where(F.col("review_key").isNotNull())
    buyers = (keyed.select("review_key", "order_key").distinct().join(o, "order_key", "inner")
              .toDF("__order_key", "__review_key", "customer_key"))
    same_order = (F.col("order_key") >= F.col("__order_key")) & (F.col("order_key") <= F.col("__order_key"))
    found = keyed.join(buyers, (F.col("review_key") == F.col("__review_key")) & same_order, "left")
    unkeyed = reviews.where(F.col("review_key").isNull()).join(o, "order_key", "left")
    columns = ["review_key", "order_key", "customer_key", "review_score", "comment_title", "comment_message",
               "creation_timestamp", "answer_timestamp"]
    return found.select(*columns).unionByName(unkeyed.select(*columns)).select(
        *columns[:6],
        F.col("creation_timestamp").alias("review_created_at"),
        F.col("answer_timestamp").alias("review_answered_at"),
        days_between("answer_timestamp", "creation_timestamp").alias("review_response_delay_days"))


def fct_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """M8: order grain with durations, delivery status and item totals.

    Items are aggregated to order grain *before* the join (map-side partial
    aggregation), so the join is one-to-one and a hot order never fans out.
    Sellers are counted from sets, which are merged map-side like the sums: one exchange of orders instead of two of
    (order, seller) pairs.  An order's set has at most one entry a seller.
    """
    per_order = items.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.size(F.collect_set("seller_key")).cast("long").alias("n_sellers"),
        money_sum("price").alias("revenue"),
        money_sum("freight_value").alias("freight"))
    delivered = F.col("delivered_customer_timestamp")
    estimated = F.col("estimated_delivery_timestamp")
    canceled, on_time, late, in_flight = DELIVERY_STATUSES
    status = (F.when(F.col("order_status").isin(*CANCELED_STATUSES), F.lit(canceled))
              .when(delivered <= estimated, F.lit(on_time))
              .when(delivered > estimated, F.lit(late))
              .otherwise(F.lit(in_flight)))
    revenue = F.coalesce("revenue", F.lit(0.0))
    freight = F.coalesce("freight", F.lit(0.0))
    return orders.join(per_order, "order_key", "left").select(
        "order_key", "customer_key", "order_status",
        F.col("purchase_timestamp").alias("purchased_at"),
        F.col("approved_at_timestamp").alias("approved_at"),
        F.col("delivered_carrier_timestamp").alias("handed_to_carrier_at"),
        delivered.alias("delivered_to_customer_at"),
        estimated.alias("estimated_delivery_at"),
        days_between(delivered, "purchase_timestamp").alias("actual_delivery_days"),
        days_between(estimated, delivered).alias("delivery_buffer_days"),
        status.alias("delivery_performance_status"),
        F.coalesce("n_items", F.lit(0)).alias("total_items_ordered"),
        F.coalesce("n_sellers", F.lit(0)).alias("unique_sellers_count"),
        revenue.alias("total_item_revenue"),
        freight.alias("total_freight_cost"),
        (revenue + freight).alias("total_order_value"))


def int_seller_performance(items: DataFrame, orders: DataFrame) -> DataFrame:
    """M9: per seller, orders handled, distinct products and the average
    delivery days at (seller, order) grain so line items do not weight it.

    Both aggregates are keyed by seller_key, so their final join is
    co-partitioned (no extra exchange).
    """
    seller_orders = items.select("seller_key", "order_key").distinct()
    days = orders.select("order_key", "actual_delivery_days")
    perf = (seller_orders.join(days, "order_key", "left")
            .groupBy("seller_key")
            .agg(F.count_distinct("order_key").alias("historical_orders_handled"),
                 exact_avg("actual_delivery_days", 1).alias("merchant_avg_delivery_days")))
    products = items.groupBy("seller_key").agg(
        F.count_distinct("product_key").alias("unique_products_cataloged"))
    return perf.join(products, "seller_key", "left").select(
        "seller_key", "historical_orders_handled", "unique_products_cataloged",
        "merchant_avg_delivery_days")
