"""Core dimensional models on small hand-made staging frames."""
import re
from datetime import date, datetime

from conftest import bronze, settings
from marketlake.plans import core
from marketlake.plans.staging import stg_order_reviews
from marketlake.session import configure


def _orders(spark, rows):
    cols = "order_key customer_key order_status purchase_timestamp approved_at_timestamp delivered_carrier_timestamp delivered_customer_timestamp estimated_delivery_timestamp".split()
    schema = ("order_key string, customer_key string, order_status string, purchase_timestamp timestamp_ntz, "
              "approved_at_timestamp timestamp_ntz, delivered_carrier_timestamp timestamp_ntz, "
              "delivered_customer_timestamp timestamp_ntz, estimated_delivery_timestamp timestamp_ntz")
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


def _items(spark, rows):
    schema = ("order_key string, order_item_id int, product_key string, seller_key string, "
              "shipping_limit_timestamp timestamp_ntz, price double, freight_value double")
    return spark.createDataFrame(rows, schema)


D = datetime


def test_fct_orders_status_branches_and_zero_fill(spark):
    orders = _orders(spark, [
        dict(order_key="cancel", customer_key="c", order_status="canceled", purchase_timestamp=D(2018, 1, 1),
             delivered_customer_timestamp=D(2018, 1, 5), estimated_delivery_timestamp=D(2018, 1, 10)),
        dict(order_key="exact", customer_key="c", order_status="delivered", purchase_timestamp=D(2018, 1, 1),
             delivered_customer_timestamp=D(2018, 1, 10), estimated_delivery_timestamp=D(2018, 1, 10)),
        dict(order_key="late", customer_key="c", order_status="delivered", purchase_timestamp=D(2018, 1, 1, 23),
             delivered_customer_timestamp=D(2018, 1, 12), estimated_delivery_timestamp=D(2018, 1, 10)),
        dict(order_key="flight", customer_key="c", order_status="shipped", purchase_timestamp=D(2018, 1, 1),
             estimated_delivery_timestamp=D(2018, 1, 10)),
    ])
    items = _items(spark, [("exact", 1, "p", "s1", None, 10.1, 2.2), ("exact", 2, "p", "s2", None, 0.2, None),
                           ("late", 1, "p", "s1", None, 5.0, 1.0), ("nope", 1, "p", "s1", None, 1.0, 1.0)])
    out = {r.order_key: r for r in core.fct_orders(orders, items).collect()}
    assert out["cancel"].delivery_performance_status == "Canceled / Unavailable"
    assert out["exact"].delivery_performance_status == "On Time / Early"
    assert out["late"].delivery_performance_status == "Late"
    assert out["flight"].delivery_performance_status == "In Flight"
    assert out["late"].actual_delivery_days == 11                      # calendar days, time ignored
    assert out["exact"].total_items_ordered == 2 and out["exact"].unique_sellers_count == 2
    assert abs(out["exact"].total_item_revenue - 10.3) < 1e-9 and out["exact"].total_freight_cost == 2.2
    assert out["flight"].total_items_ordered == 0 and out["flight"].total_order_value == 0.0
    assert len(out) == 4                                                # item without order ignored


def test_fct_order_items_inner_join_and_total(spark):
    orders = _orders(spark, [dict(order_key="o1", customer_key="c1", order_status="delivered", purchase_timestamp=D(2018, 1, 1))])
    items = _items(spark, [("o1", 1, "p", "s", None, 10.0, 1.5), ("orphan", 1, "p", "s", None, 1.0, 1.0)])
    rows = core.fct_order_items(items, orders).collect()
    assert len(rows) == 1 and rows[0].total_item_value == 11.5 and rows[0].customer_key == "c1"


def test_dim_products_category_fallback(spark):
    products = spark.createDataFrame(
        [("p1", "beleza"), ("p2", "sem_traducao"), ("p3", None)],
        "product_key string, category_name_portuguese string").selectExpr(
        "*", "1 as name_char_length", "1 as description_char_length", "1 as photo_count",
        "1.0 as weight_grams", "1.0 as length_cm", "1.0 as height_cm", "1.0 as width_cm")
    tr = spark.createDataFrame([("beleza", "beauty")], "category_name_portuguese string, category_name_english string")
    out = {r.product_key: r.category_name for r in core.dim_products(products, tr).collect()}
    assert out == {"p1": "beauty", "p2": "sem_traducao", "p3": "Uncategorized"}


def test_dim_dates_calendar(spark):
    cal = core.dim_dates(core.fixed_bounds(spark, "2016-01-01", "2020-12-31"))
    assert cal.count() == 1827
    r = cal.filter("date_key = date'2016-01-03'").first()
    assert (r.day_of_week, r.day_name, r.is_weekend, r.quarter_year, r.month_name) == (1, "Sunday", True, "Q1-2016", "January")


def test_data_bounds_whole_years(spark):
    orders = _orders(spark, [dict(order_key="a", purchase_timestamp=D(2017, 5, 3), estimated_delivery_timestamp=D(2019, 2, 1))])
    r = core.data_bounds(orders).first()
    assert (r.start_date, r.end_date) == (date(2017, 1, 1), date(2019, 12, 31))


def test_payment_surrogate_key_and_dims(spark):
    pay = spark.createDataFrame([("o1", 1, "boleto", 1, 10.0), (None, 2, "voucher", 1, 5.0)],
                                "order_key string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    out = core.fct_order_payments(pay).collect()
    import hashlib
    assert out[0].order_payment_key == hashlib.md5(b"o1-1").hexdigest()
    assert out[1].order_payment_key == hashlib.md5(b"-2").hexdigest()


def test_int_seller_performance_order_grain(spark):
    items = spark.createDataFrame([("o1", "s1", "p1"), ("o1", "s1", "p2"), ("o2", "s1", "p1")],
                                  "order_key string, seller_key string, product_key string")
    orders = spark.createDataFrame([("o1", 10), ("o2", 3)], "order_key string, actual_delivery_days int")
    r = core.int_seller_performance(items, orders).first()
    assert (r.historical_orders_handled, r.unique_products_cataloged, r.merchant_avg_delivery_days) == (2, 2, 6.5)


def test_int_seller_performance_on_dirty_rows(spark):
    item_rows = [("o1", "s1", "p1"), ("o1", "s1", "p2"), ("o2", "s1", "p1"), ("o3", None, "p3"),
                 ("o4", "s2", "p4"), ("o5", "s2", None)]
    order_rows = [("o1", 10), ("o1", 10), ("o2", None), ("o3", 2), ("o4", 7)]          # o1 duplicated
    items = spark.createDataFrame(item_rows, "order_key string, seller_key string, product_key string")
    orders = spark.createDataFrame(order_rows, "order_key string, actual_delivery_days int")
    got = sorted((tuple(r) for r in core.int_seller_performance(items, orders).collect()),
                 key=lambda t: (t[0] is None, t[0] or ""))
    # o1 is there twice; the lines without a seller have no catalogue
    assert got == [("s1", 2, 2, 10.0), ("s2", 2, 1, 7.0), (None, 1, None, 2.0)]


def test_calendar_spans_late_purchases_without_estimate(spark):
    orders = _orders(spark, [dict(order_key="a", purchase_timestamp=D(2017, 5, 3), estimated_delivery_timestamp=D(2017, 6, 1)),
                             dict(order_key="b", purchase_timestamp=D(2018, 3, 3), estimated_delivery_timestamp=None)])
    r = core.data_bounds(orders).first()
    assert (r.start_date, r.end_date) == (date(2017, 1, 1), date(2018, 12, 31))


def test_amounts_below_a_cent_are_kept(spark):
    orders = _orders(spark, [dict(order_key="a", purchase_timestamp=D(2017, 5, 3))])
    items = spark.createDataFrame([("a", "s", 1.005, 0.004)], "order_key string, seller_key string, price double, freight_value double")
    r = core.fct_orders(orders, items).first()
    assert (r.total_item_revenue, r.total_freight_cost, r.total_order_value) == (1.005, 0.004, 1.009)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_splits_bound_the_memory_of_a_task(spark):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    session = spark.newSession()
    with settings(session, {}):
        for k in keys:
            session.conf.unset(k)
        configure(session)
        assert [int(session.conf.get(k).removesuffix("MB")) <= 16 for k in keys] == [True, True]
    session.conf.set(keys[0], "64MB")
    assert configure(session).conf.get(keys[0]) == "64MB"          # what the cluster sets holds


def test_sellers_of_an_order_need_one_exchange(spark):
    orders = _orders(spark, [dict(order_key="a"), dict(order_key="b"), dict(order_key="c"), dict(order_key=None)])
    items = spark.createDataFrame([("a", "s", 1.0, 0.5), ("a", "s", 2.0, 0.5), ("a", "t", 3.0, None), ("a", None, 4.0, 0.0),
                                   ("b", None, 5.0, 1.0), (None, "s", 9.0, 9.0)],
                                  "order_key string, seller_key string, price double, freight_value double")
    out = core.fct_orders(orders, items)
    assert not re.search(r"hashpartitioning\(order_key#\d+, seller_key", _plan(out))
    got = {r.order_key: (r.total_items_ordered, r.unique_sellers_count, r.total_item_revenue, r.total_freight_cost) for r in out.collect()}
    assert got == {"a": (4, 2, 10.0, 1.0), "b": (1, 0, 5.0, 1.0), "c": (0, 0, 0.0, 0.0), None: (0, 0, 0.0, 0.0)}
    assert dict(out.dtypes)["unique_sellers_count"] == "bigint"


def test_review_messages_are_dealt_once(spark):
    raw = bronze(spark, "order_reviews", [
        dict(review_id="r1", order_id="a", review_score=1, review_comment_message="x", review_creation_date="2018-01-02"),
        dict(review_id="r1", order_id="b", review_score=2, review_comment_message="y", review_creation_date="2018-01-03"),
        dict(review_id="r2", order_id="a", review_score=3, review_comment_message="z", review_creation_date="2018-01-03"),
        dict(review_id="r3", order_id="none", review_score=4), dict(review_id="r4", review_score=5),
        dict(order_id="a", review_score=1), dict(order_id="none", review_score=1), dict(review_score=2)])
    orders = _orders(spark, [dict(order_key="a", customer_key="c1"), dict(order_key="b", customer_key="c2"), dict(order_key="b", customer_key="c3"),
                             dict(order_key="b", customer_key=None), dict(order_key=None, customer_key="c9")])
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        for reviews in (stg_order_reviews(raw), stg_order_reviews(raw).unionByName(stg_order_reviews(raw))):
            out = core.fct_order_reviews(reviews, orders)
            expected = reviews.join(orders.select("order_key", "customer_key"), "order_key", "left")
            columns = ["review_key", "order_key", "customer_key", "review_score", "comment_message"]
            assert sorted(map(str, out.select(*columns).collect())) == sorted(map(str, expected.select(*columns).collect()))
        keyed = core.fct_order_reviews(stg_order_reviews(raw), orders).where("review_key is not null")
        assert re.search(r"ReusedExchange \[review_key[^\]]*comment_message", _plan(keyed))
