"""Gold marts: business aggregates, the hub what-if projection and routing.

Money is summed exactly (whole amounts and millionths, two longs) and rounded half-up; averages are exact
quotients rounded half-up.  Hot keys (one seller, buyer or order holding a
large share of rows) are handled by pre-aggregating below every join that
would otherwise fan them into a single task, by map-side partial aggregation
in every groupBy, and by adaptive skew-join splitting in the remaining joins.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.expressions import (
    KEYWORD_GROUPS, UNITS, amount, amount_sum, amount_total, contains_any, count_if, days_between, exact_avg, exact_ratio,
    hub_for_state, in_units, pct, rounded_units,
)
from marketlake.operators.aggregates import distinct_then_avg, top_k

MONTH_KEYS = ["calendar_year", "calendar_month", "month_name", "quarter_year"]


def category_performance(items: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """G1: revenue, units, orders and unit economics per category, plus the
    review average over distinct (order, category, score).

    Money and units are aggregated per product before the product join, so
    that join sees one row per product instead of one per line.  The distinct
    (category, order) pairs are built once and feed both the order count and
    the review join (with distinct (order, score) pairs on the other side, so a
    hot order with many lines and reviews never emits lines x reviews rows).
    """
    categories = products.select("product_key", "category_name")
    per_product = items.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("units"),
        amount_sum("total_item_value").alias("value"),
        amount_sum("price").alias("merchandise"),
        amount_sum("freight_value").alias("freight"))
    totals = per_product.join(categories, "product_key", "inner").groupBy("category_name").agg(
        rounded_units(in_units(amount_total("value"))).alias("total_category_revenue"),
        rounded_units(in_units(amount_total("merchandise"))).alias("total_merchandise_revenue"),
        rounded_units(in_units(amount_total("freight"))).alias("total_freight_revenue"),
        F.sum("units").alias("units_sold"),
        exact_ratio(in_units(amount_total("value")), F.sum("units").cast("decimal(20,0)") * F.lit(Decimal(UNITS)), 2).alias("revenue_per_unit"),
        exact_ratio(in_units(amount_total("freight")), F.sum("units").cast("decimal(20,0)") * F.lit(Decimal(UNITS)), 2).alias("freight_per_unit"))
    category_orders = (items.select("order_key", "product_key")
                       .join(categories, "product_key", "inner")
                       .select("category_name", "order_key").distinct())
    order_counts = category_orders.groupBy("category_name").agg(
        F.count("order_key").alias("total_orders"))
    scored = category_orders.join(reviews.select("order_key", "review_score").distinct(), "order_key", "inner")
    review_avg = distinct_then_avg(scored, ["category_name"], ["order_key"], "review_score", 2,
                                   "avg_review_score")
    return (totals.join(order_counts, "category_name", "left")
            .join(review_avg, "category_name", "left")
            .select("category_name", "total_category_revenue", "total_merchandise_revenue",
                    "total_freight_revenue", "units_sold",
                    F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
                    "revenue_per_unit", "freight_per_unit",
                    F.coalesce("avg_review_score", F.lit(0.0)).alias("avg_review_score")))


def customer_cohorts(orders: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly buyers split into New (ordering on their first purchase
    date) and Returning, GMV split, repeat rate and days since first purchase.

    Orders are first collapsed to (buyer, day); the first purchase day is a
    window minimum over those few rows per buyer, so a buyer with a third of
    all orders never reaches one task with all of them.  Buyer-level flags are
    then rolled up per month with partial aggregation.
    """
    buyer_orders = (orders.select("order_key", "customer_key", "purchased_at", "total_order_value")
                    .join(customers.select("customer_key", "customer_unique_id"), "customer_key", "inner")
                    .filter(F.col("customer_unique_id").isNotNull())
                    .select("order_key", "customer_unique_id",
                            F.to_date("purchased_at").alias("purchase_date"),
                            "total_order_value"))
    # gmv as two exact longs until the final roll-up.
    daily = buyer_orders.groupBy("customer_unique_id", "purchase_date").agg(
        F.count(F.lit(1)).alias("n_orders"),
        amount_sum("total_order_value").alias("gmv"))
    first = F.min("purchase_date").over(Window.partitionBy("customer_unique_id"))
    daily = daily.select("*", first.alias("first_purchase_date")).select(
        "*", (F.col("purchase_date") == F.col("first_purchase_date")).alias("is_new"),
        days_between("purchase_date", "first_purchase_date").alias("days_since"))
    calendar = dates.select(F.col("date_key").alias("purchase_date"), *MONTH_KEYS)
    returning = ~F.col("is_new")
    per_buyer = (daily.join(calendar, "purchase_date", "inner")
                 .groupBy(*MONTH_KEYS, "customer_unique_id").agg(
                     F.max(F.col("is_new").cast("int")).alias("has_new"),
                     F.max(returning.cast("int")).alias("has_returning"),
                     amount_total("gmv").alias("gmv"),
                     amount_total("gmv", when=F.col("is_new")).alias("gmv_new"),
                     amount_total("gmv", when=returning).alias("gmv_returning"),
                     F.sum(F.when(returning, F.col("days_since") * F.col("n_orders"))).alias("days_sum"),
                     F.sum(F.when(returning, F.col("n_orders"))).alias("days_n")))
    monthly = per_buyer.groupBy(*MONTH_KEYS).agg(
        F.count(F.lit(1)).alias("total_unique_buyers"),
        count_if(F.col("has_new") == 1).alias("new_buyers_count"),
        count_if(F.col("has_returning") == 1).alias("returning_buyers_count"),
        rounded_units(in_units(amount_total("gmv"))).alias("total_gmv"),
        rounded_units(in_units(amount_total("gmv_new"))).alias("new_buyer_gmv"),
        rounded_units(in_units(amount_total("gmv_returning"))).alias("returning_buyer_gmv"),
        pct(count_if(F.col("has_returning") == 1), F.count(F.lit(1)), 2).alias("repeat_buyer_rate_pct"),
        exact_ratio(F.sum("days_sum").cast("decimal(20,0)"), F.sum("days_n"), 1)
        .alias("avg_days_since_first_purchase"))
    order_counts = (buyer_orders.join(calendar, "purchase_date", "inner")
                    .groupBy(*MONTH_KEYS).agg(F.count_distinct("order_key").alias("total_orders")))
    return monthly.join(order_counts, MONTH_KEYS, "inner").select(
        *MONTH_KEYS, "total_unique_buyers", "new_buyers_count", "returning_buyers_count",
        "total_orders", "total_gmv", "new_buyer_gmv", "returning_buyer_gmv",
        "repeat_buyer_rate_pct", "avg_days_since_first_purchase")


def executive_overview(orders: DataFrame, items: DataFrame, customers: DataFrame,
                       saving: Decimal | str = Decimal("0.35")) -> DataFrame:
    """What-if of hub consolidation at order-line grain.

    optimized days = least(actual, greatest(1, round(actual * (1 - saving)))),
    optimized freight = round(freight * (1 - saving), 2); late when the
    optimized days exceed the promised days.
    """
    factor = Decimal(1) - Decimal(str(saving))
    o = orders.select("order_key", "customer_key", "purchased_at", "estimated_delivery_at",
                      "actual_delivery_days").filter(F.col("actual_delivery_days").isNotNull())
    i = items.select("order_key", "seller_key", "freight_value").filter(
        F.col("freight_value").isNotNull())
    c = customers.select("customer_key", F.col("state").alias("customer_state"))
    actual = F.col("actual_delivery_days")
    scaled = F.round(actual.cast("decimal(10,0)") * F.lit(factor), 0)
    opt_days = F.coalesce(F.least(actual.cast("decimal(10,0)"), F.greatest(F.lit(1), scaled)),
                          F.lit(0)).cast("int")
    opt_freight = F.coalesce(F.round(F.col("freight_value") * F.lit(float(factor)), 2), F.lit(0.0))
    sim = o.join(i, "order_key", "inner").join(c, "customer_key", "inner").select(
        "order_key", "customer_key", "seller_key", "customer_state", "purchased_at",
        "estimated_delivery_at",
        actual.alias("actual_shipping_days"),
        F.col("freight_value").alias("actual_freight"),
        opt_days.alias("optimized_shipping_days"),
        opt_freight.alias("optimized_freight"))
    promised = days_between("estimated_delivery_at", "purchased_at")
    return sim.select(
        "*",
        (F.col("actual_shipping_days") - F.col("optimized_shipping_days")).alias("days_saved"),
        F.round(F.col("actual_freight") - F.col("optimized_freight"), 2).alias("freight_dollars_saved"),
        F.when(F.col("optimized_shipping_days") > promised, F.lit(1)).otherwise(F.lit(0))
        .alias("is_optimized_late"))


def payment_analysis(payments: DataFrame, orders: DataFrame, dedupe_orders: bool = False) -> DataFrame:
    """Per payment type, transactions, installments, captured value and the
    associated order GMV.

    As in the source model, an order's value is counted once per payment row
    (an order split over two payments of one type counts twice), which biases
    the discrepancy; `dedupe_orders=True` counts it once per (type, order).
    Payments are first aggregated per (type, order), so the order join sees
    one row per pair and the value is weighted by the payment count.
    """
    per_order = payments.groupBy("payment_type", "order_key").agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.sum("installment_count").alias("inst_sum"),
        F.count("installment_count").alias("inst_n"),
        amount_sum("payment_amount").alias("amount"),
        F.count("payment_amount").alias("amount_n"))
    value = orders.select("order_key", amount("total_order_value").alias("order_value"))
    j = per_order.join(value, "order_key", "left")
    gmv = in_units(amount_total("order_value", weight=None if dedupe_orders else F.col("n_payments")))
    return j.groupBy("payment_type").agg(
        F.count_distinct("order_key").alias("total_orders_using_payment_type"),
        F.sum("n_payments").alias("total_payment_transactions"),
        exact_ratio(F.sum("inst_sum").cast("decimal(20,0)"), F.sum("inst_n"), 1)
        .alias("avg_installment_count"),
        rounded_units(in_units(amount_total("amount"))).alias("total_captured_payment_value"),
        exact_ratio(in_units(amount_total("amount")), F.sum("amount_n").cast("decimal(20,0)") * F.lit(Decimal(UNITS)), 2)
        .alias("avg_payment_transaction_value"),
        rounded_units(gmv).alias("total_associated_order_gmv"),
        rounded_units(in_units(amount_total("amount")) - gmv).alias("payment_reconciliation_discrepancy"))


def regional_logistics(items: DataFrame, orders: DataFrame, sellers: DataFrame,
                       customers: DataFrame) -> DataFrame:
    """Per (origin state, destination state) corridor, orders, fulfilled
    rows, SLA breach rate, average days and freight at (order, seller,
    customer, freight) grain."""
    i = items.select("order_key", "seller_key", "customer_key", "freight_value").distinct()
    o = orders.select("order_key", "actual_delivery_days", "delivery_performance_status",
                      "delivered_to_customer_at")
    s = sellers.select("seller_key", F.col("state").alias("origin_state"))
    c = customers.select("customer_key", F.col("state").alias("destination_state"))
    j = (i.join(o, "order_key", "inner").join(s, "seller_key", "inner")
         .join(c, "customer_key", "inner")
         .filter(F.col("origin_state").isNotNull() & F.col("destination_state").isNotNull()))
    fulfilled = count_if(F.col("delivered_to_customer_at").isNotNull())
    return j.groupBy("origin_state", "destination_state").agg(
        F.count_distinct("order_key").alias("total_orders_shipped"),
        fulfilled.alias("fulfilled_orders_count"),
        pct(count_if(F.col("delivery_performance_status") == "Late"), fulfilled, 2)
        .alias("sla_breach_rate_pct"),
        exact_avg("actual_delivery_days", 1).alias("avg_delivery_days"),
        exact_avg("freight_value", 2, is_money=True).alias("avg_freight_cost_per_item"))


def message_signals(message: Column, keyword_groups: dict | None = None) -> Column:
    """Struct of what `review_text_signals` asks of one message: whether it is written, and which complaint keywords it
    has (substring match on the lower-cased whole message)."""
    groups = keyword_groups or KEYWORD_GROUPS
    text = F.lower(F.coalesce(message, F.lit("")))
    return F.struct((message.isNotNull() & (F.trim(message) != "")).alias("has_comment"),
                    *[contains_any(text, tuple(words)).alias(name) for name, words in groups.items()])


def review_text_signals(reviews: DataFrame, keyword_groups: dict | None = None) -> DataFrame:
    """Per review score, comment coverage, response delay and complaint
    keyword counts."""
    return signal_totals(reviews.withColumn("comment_message", message_signals(F.col("comment_message"), keyword_groups)), keyword_groups)


def signal_totals(reviews: DataFrame, keyword_groups: dict | None = None) -> DataFrame:
    """G6 of reviews whose messages were replaced by their `message_signals`."""
    groups = keyword_groups or KEYWORD_GROUPS
    prepared = reviews.select("review_score", "review_response_delay_days", "comment_message.*")
    written = count_if(F.col("has_comment"))
    return prepared.groupBy("review_score").agg(
        F.count(F.lit(1)).alias("total_reviews_count"),
        written.alias("reviews_with_written_comments_count"),
        pct(written, F.count(F.lit(1)), 2).alias("comment_written_rate_pct"),
        exact_avg("review_response_delay_days", 1).alias("avg_merchant_response_delay_days"),
        *[count_if(F.col(name)).alias(name) for name in groups])


def seller_scorecard(perf: DataFrame, sellers: DataFrame, items: DataFrame,
                     customers: DataFrame, reviews: DataFrame) -> DataFrame:
    """Seller profile, velocity, distinct human buyers, revenue and the
    review average over distinct (seller, order, score)."""
    # Lines are collapsed to (seller, customer) before the customer join; the
    # line count and exact sums carry through, so the totals are unchanged.
    seller_customers = items.groupBy("seller_key", "customer_key").agg(
        F.count(F.lit(1)).alias("n_lines"), amount_sum("total_item_value").alias("value"))
    buyers = (seller_customers
              .join(customers.select("customer_key", "customer_unique_id"), "customer_key", "inner")
              .groupBy("seller_key").agg(
                  F.count_distinct("customer_unique_id").alias("unique_buyers_served"),
                  rounded_units(in_units(amount_total("value"))).alias("total_gross_revenue"),
                  F.sum("n_lines").alias("total_items_sold")))
    scored = items.select("seller_key", "order_key").distinct().join(
        reviews.select("order_key", "review_score").distinct(), "order_key", "inner")
    review_avg = distinct_then_avg(scored, ["seller_key"], ["order_key"], "review_score", 2,
                                   "avg_review_score")
    s = sellers.select("seller_key", F.col("city").alias("seller_city"),
                       F.col("state").alias("seller_state"), "latitude", "longitude")
    return (s.join(perf, "seller_key", "inner")
            .join(buyers, "seller_key", "left")
            .join(review_avg, "seller_key", "left")
            .select("seller_key", "seller_city", "seller_state", "latitude", "longitude",
                    "historical_orders_handled", "unique_products_cataloged",
                    "merchant_avg_delivery_days", "unique_buyers_served", "total_items_sold",
                    "total_gross_revenue",
                    F.coalesce("avg_review_score", F.lit(0.0)).alias("avg_review_score")))


ROUTE_COLUMNS = ["order_key", "seller_city", "seller_state", "seller_lat", "seller_lon",
                 "customer_city", "customer_state", "customer_lat", "customer_lon",
                 "hub_name", "hub_lat", "hub_lon"]


def spatial_routing(items: DataFrame, sellers: DataFrame, customers: DataFrame,
                    n: int | None = None, keys: bool = False) -> DataFrame:
    """Seller -> customer routes with the serving hub (by customer state).

    Every route is returned; `n` keeps a deterministic sample, the first n routes by (order, seller,
    customer) key (`route_sample`).  `keys=True` also returns
    seller_key and customer_key (needed to match routes by seller).
    """
    i = items.select("order_key", "seller_key", "customer_key").distinct()
    s = sellers.select("seller_key", F.col("city").alias("seller_city"),
                       F.col("state").alias("seller_state"),
                       F.col("latitude").alias("seller_lat"), F.col("longitude").alias("seller_lon"))
    c = customers.select("customer_key", F.col("city").alias("customer_city"),
                         F.col("state").alias("customer_state"),
                         F.col("latitude").alias("customer_lat"),
                         F.col("longitude").alias("customer_lon"))
    routes = (i.join(s, "seller_key", "inner").join(c, "customer_key", "inner")
              .filter(F.col("seller_lat").isNotNull() & F.col("seller_lon").isNotNull()
                      & F.col("customer_lat").isNotNull() & F.col("customer_lon").isNotNull())
              .withColumn("hub", hub_for_state("customer_state"))
              .select("order_key", "seller_key", "customer_key", *ROUTE_COLUMNS[1:9],
                      "hub.hub_name", "hub.hub_lat", "hub.hub_lon"))
    if n is not None:
        routes = top_k(routes, [F.col("order_key"), F.col("seller_key"), F.col("customer_key")], n)
    return routes.select(*ROUTE_COLUMNS, *(["seller_key", "customer_key"] if keys else []))


__all__ = ["category_performance", "customer_cohorts", "executive_overview", "payment_analysis",
           "regional_logistics", "review_text_signals", "seller_scorecard", "spatial_routing",
]
