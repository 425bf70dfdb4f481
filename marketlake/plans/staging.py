"""Staging models: bronze strings -> typed, renamed, deduplicated tables.

Each function takes the all-string bronze frame of one source.  Casts are
strict (ANSI: a malformed value fails the job) except for reviews, whose
score and timestamps are parsed with `try_cast` (bad value -> null).
Timestamps are naive wall-clock values (`timestamp_ntz`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.dedup import keep_first, keep_first_wide

TS = "timestamp_ntz"

# Bounding box that keeps coordinates inside the country (closed intervals).
LAT_RANGE = (-34.0, 6.0)
LNG_RANGE = (-74.0, -34.0)


def stg_customers(raw: DataFrame) -> DataFrame:
    """One row per customer_key (the customer id of an order)."""
    return raw.select(
        F.col("customer_id").alias("customer_key"),
        F.col("customer_unique_id"),
        F.col("customer_zip_code_prefix").cast("string").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One representative point per zip prefix inside the bounding box.

    The lowest (latitude, longitude) wins; further ties by city, state.
    """
    typed = raw.select(
        F.col("geolocation_zip_code_prefix").cast("string").alias("zip_code_prefix"),
        F.col("geolocation_lat").cast("double").alias("latitude"),
        F.col("geolocation_lng").cast("double").alias("longitude"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    ).filter(F.col("latitude").between(*LAT_RANGE) & F.col("longitude").between(*LNG_RANGE))
    return keep_first(typed, ["zip_code_prefix"],
                      [F.col("latitude").asc_nulls_last(), F.col("longitude").asc_nulls_last()])


def stg_order_items(raw: DataFrame) -> DataFrame:
    """One row per (order_key, order_item_id)."""
    return raw.select(
        F.col("order_id").alias("order_key"),
        F.col("order_item_id").cast("int").alias("order_item_id"),
        F.col("product_id").alias("product_key"),
        F.col("seller_id").alias("seller_key"),
        F.col("shipping_limit_date").cast(TS).alias("shipping_limit_timestamp"),
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    """T4: one row per (order_key, payment_sequential)."""
    return raw.select(
        F.col("order_id").alias("order_key"),
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        F.col("payment_type"),
        F.col("payment_installments").cast("int").alias("payment_installments"),
        F.col("payment_value").cast("double").alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """T5: one row per review_key, keeping the latest answered/created version.

    Messages are by far the widest column: only those of reviews with several versions cross an exchange."""
    typed = raw.select(
        F.col("review_id").alias("review_key"),
        F.col("order_id").alias("order_key"),
        F.col("review_score").try_cast("int").alias("review_score"),
        F.col("review_comment_title").alias("comment_title"),
        F.col("review_comment_message").alias("comment_message"),
        F.col("review_creation_date").try_cast(TS).alias("creation_timestamp"),
        F.col("review_answer_timestamp").try_cast(TS).alias("answer_timestamp"),
    )
    latest = F.coalesce(F.col("answer_timestamp"), F.col("creation_timestamp"))
    return keep_first_wide(typed, ["review_key"], [latest.desc_nulls_last()])


def stg_orders(raw: DataFrame) -> DataFrame:
    """Order header, five lifecycle timestamps; not deduplicated."""
    return raw.select(
        F.col("order_id").alias("order_key"),
        F.col("customer_id").alias("customer_key"),
        F.col("order_status"),
        F.col("order_purchase_timestamp").cast(TS).alias("purchase_timestamp"),
        F.col("order_approved_at").cast(TS).alias("approved_at_timestamp"),
        F.col("order_delivered_carrier_date").cast(TS).alias("delivered_carrier_timestamp"),
        F.col("order_delivered_customer_date").cast(TS).alias("delivered_customer_timestamp"),
        F.col("order_estimated_delivery_date").cast(TS).alias("estimated_delivery_timestamp"),
    )


def stg_category_translation(raw: DataFrame) -> DataFrame:
    """One English name per Portuguese category."""
    typed = raw.select(
        F.col("product_category_name").alias("category_name_portuguese"),
        F.col("product_category_name_english").alias("category_name_english"),
    )
    return keep_first(typed, ["category_name_portuguese"], [])


def stg_products(raw: DataFrame) -> DataFrame:
    """Product attributes; misspelt header names mapped to clean ones."""
    return raw.select(
        F.col("product_id").alias("product_key"),
        F.col("product_category_name").alias("category_name_portuguese"),
        F.col("product_name_lenght").cast("int").alias("name_char_length"),
        F.col("product_description_lenght").cast("int").alias("description_char_length"),
        F.col("product_photos_qty").cast("int").alias("photo_count"),
        F.col("product_weight_g").cast("double").alias("weight_grams"),
        F.col("product_length_cm").cast("double").alias("length_cm"),
        F.col("product_height_cm").cast("double").alias("height_cm"),
        F.col("product_width_cm").cast("double").alias("width_cm"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    """One row per seller_key."""
    typed = raw.select(
        F.col("seller_id").alias("seller_key"),
        F.col("seller_zip_code_prefix").cast("string").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
    )
    return keep_first(typed, ["seller_key"], [])


STAGING = {
    "stg_customers": ("customers", stg_customers),
    "stg_geolocation": ("geolocation", stg_geolocation),
    "stg_order_items": ("order_items", stg_order_items),
    "stg_order_payments": ("order_payments", stg_order_payments),
    "stg_order_reviews": ("order_reviews", stg_order_reviews),
    "stg_orders": ("orders", stg_orders),
    "stg_category_translation": ("category_translation", stg_category_translation),
    "stg_products": ("products", stg_products),
    "stg_sellers": ("sellers", stg_sellers),
}


def build_staging(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging models from the nine bronze frames (lazy)."""
    return {name: fn(bronze[src]) for name, (src, fn) in STAGING.items()}
