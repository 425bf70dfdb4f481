"""Staging models on hand-made bronze rows (edge cases per source)."""
from conftest import bronze

from marketlake.plans import staging


def test_customers_keep_leading_zero_zip(spark):
    raw = bronze(spark, "customers", [dict(customer_id="c1", customer_unique_id="u1",
                                           customer_zip_code_prefix="01037", customer_city="sao paulo",
                                           customer_state="SP")])
    row = staging.stg_customers(raw).first()
    assert row.zip_code_prefix == "01037"
    assert staging.stg_customers(raw).columns == ["customer_key", "customer_unique_id",
                                                  "zip_code_prefix", "city", "state"]


def test_geolocation_box_dedup_and_ties(spark):
    rows = [
        dict(geolocation_zip_code_prefix="00001", geolocation_lat="6.0", geolocation_lng="-50", geolocation_city="b", geolocation_state="AM"),
        dict(geolocation_zip_code_prefix="00002", geolocation_lat="6.1", geolocation_lng="-50", geolocation_city="x", geolocation_state="AM"),
        dict(geolocation_zip_code_prefix="00003", geolocation_lat="-20.5", geolocation_lng="-44", geolocation_city="z", geolocation_state="MG"),
        dict(geolocation_zip_code_prefix="00003", geolocation_lat="-21.0", geolocation_lng="-45", geolocation_city="y", geolocation_state="MG"),
        dict(geolocation_zip_code_prefix="00004", geolocation_lat="-10", geolocation_lng="-40", geolocation_city="beta", geolocation_state="BA"),
        dict(geolocation_zip_code_prefix="00004", geolocation_lat="-10", geolocation_lng="-40", geolocation_city="alpha", geolocation_state="BA"),
    ]
    out = {r.zip_code_prefix: r for r in staging.stg_geolocation(bronze(spark, "geolocation", rows)).collect()}
    assert set(out) == {"00001", "00003", "00004"}          # 6.0 kept (closed box), 6.1 dropped
    assert out["00003"].latitude == -21.0                    # lowest latitude wins
    assert out["00004"].city == "alpha"                      # tie broken deterministically


def test_reviews_try_cast_and_keep_latest(spark):
    rows = [
        dict(review_id="r1", order_id="o1", review_score="5", review_creation_date="2018-01-01 00:00:00",
             review_answer_timestamp="2018-01-03 10:00:00", review_comment_message="old"),
        dict(review_id="r1", order_id="o1", review_score="1", review_creation_date="2018-01-01 00:00:00",
             review_answer_timestamp="2018-01-05 10:00:00", review_comment_message="new"),
        dict(review_id="r2", order_id="o2", review_score="abc", review_creation_date="2018-02-01 00:00:00",
             review_answer_timestamp=None),
        dict(review_id="r3", order_id="o3", review_score="4", review_creation_date="garbage",
             review_answer_timestamp="2018-03-01 00:00:00"),
    ]
    out = {r.review_key: r for r in staging.stg_order_reviews(bronze(spark, "order_reviews", rows)).collect()}
    assert len(out) == 3
    assert out["r1"].comment_message == "new" and out["r1"].review_score == 1
    assert out["r2"].review_score is None and out["r2"].answer_timestamp is None
    assert out["r3"].creation_timestamp is None and out["r3"].answer_timestamp is not None


def test_orders_strict_cast_and_no_dedup(spark):
    rows = [dict(order_id="o1", customer_id="c1", order_status="delivered",
                 order_purchase_timestamp="2017-10-02 10:56:33", order_estimated_delivery_date="2017-10-18 00:00:00")] * 2
    out = staging.stg_orders(bronze(spark, "orders", rows))
    assert out.count() == 2
    assert dict(out.dtypes)["purchase_timestamp"] == "timestamp_ntz"


def test_products_rename_misspelt_headers(spark):
    raw = bronze(spark, "products", [dict(product_id="p1", product_category_name="perfumaria",
                                          product_name_lenght="40", product_description_lenght="287",
                                          product_photos_qty="1", product_weight_g="225",
                                          product_length_cm="16", product_height_cm="10", product_width_cm="14")])
    r = staging.stg_products(raw).first()
    assert (r.name_char_length, r.description_char_length, r.photo_count, r.weight_grams) == (40, 287, 1, 225.0)


def test_seller_and_translation_dedup(spark):
    sellers = bronze(spark, "sellers", [dict(seller_id="s1", seller_zip_code_prefix="13023", seller_city="b", seller_state="SP"),
                                        dict(seller_id="s1", seller_zip_code_prefix="13023", seller_city="a", seller_state="SP")])
    assert staging.stg_sellers(sellers).count() == 1
    tr = bronze(spark, "category_translation", [dict(product_category_name="beleza_saude", product_category_name_english="health_beauty")] * 3)
    assert staging.stg_category_translation(tr).count() == 1


def test_wide_dedup_equals_keep_first(spark, monkeypatch):
    """Repeated, null and tied keys, with a map of keys large and small enough that unrelated keys share slots."""
    from pyspark.sql import functions as F

    from marketlake.operators import dedup
    i = F.col("id")
    rows = spark.range(3000).select(F.when(i % 97 != 0, F.concat(F.lit("k"), (i % 2500).cast("string"))).alias("key"), (i % 3).alias("at"),
                                    F.repeat(F.lit("text"), (i % 5).cast("int")).alias("text"))
    rows = rows.unionByName(rows.where("at = 1"))
    expected = sorted(map(str, dedup.keep_first(rows, ["key"], [F.col("at").desc_nulls_last()]).collect()))
    for slots in (1 << 26, 1 << 15):
        monkeypatch.setattr(dedup, "KEY_SLOTS", slots)
        got = dedup.keep_first_wide(rows, ["key"], [F.col("at").desc_nulls_last()])
        assert sorted(map(str, got.collect())) == expected and got.columns == rows.columns
