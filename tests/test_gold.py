"""Gold marts on hand-made core frames (FIXTURES edge rows)."""
from datetime import datetime as D

from marketlake.plans import gold


def test_executive_overview_days_and_freight(spark):
    days = [0, 1, 2, 10, 30, -3]
    orders = spark.createDataFrame(
        [(f"o{i}", "c1", D(2018, 1, 1), D(2018, 1, 21), d) for i, d in enumerate(days)] +
        [("undelivered", "c1", D(2018, 1, 1), D(2018, 1, 21), None)],
        "order_key string, customer_key string, purchased_at timestamp_ntz, estimated_delivery_at timestamp_ntz, actual_delivery_days int")
    items = spark.createDataFrame([(f"o{i}", "s1", 10.0, 10.1) for i in range(len(days))] + [("o0", "s2", 1.0, None)],
                                  "order_key string, seller_key string, price double, freight_value double")
    customers = spark.createDataFrame([("c1", "SP")], "customer_key string, state string")
    out = gold.executive_overview(orders, items, customers).orderBy("order_key").collect()
    assert [r.optimized_shipping_days for r in out] == [0, 1, 1, 7, 20, -3]
    assert all(r.optimized_freight == 6.57 for r in out)        # round(10.1 * 0.65, 2)
    assert all(r.freight_dollars_saved == 3.53 for r in out)
    assert [r.is_optimized_late for r in out] == [0, 0, 0, 0, 0, 0]
    assert dict(gold.executive_overview(orders, items, customers).dtypes)["optimized_shipping_days"] == "int"


def test_review_text_signals_rules(spark):
    rows = [(5, None, 1), (5, "   ", 2), (5, "Entrega com ATRASO", None), (5, "chocolate", 4),
            (1, "produto quebrado e ruim", 0)]
    reviews = spark.createDataFrame(rows, "review_score int, comment_message string, review_response_delay_days int")
    out = {r.review_score: r for r in gold.review_text_signals(reviews).collect()}
    five = out[5]
    assert (five.total_reviews_count, five.reviews_with_written_comments_count) == (4, 2)
    assert five.comment_written_rate_pct == 50.0
    assert five.delay_complaint_count == 2                     # ATRASO, and 'late' inside chocolate
    assert five.avg_merchant_response_delay_days == 2.3        # (1+2+4)/3 = 2.333 -> 2.3
    assert (out[1].damage_complaint_count, out[1].poor_quality_complaint_count) == (1, 1)


def test_spatial_routing_hub_default_and_null_filter(spark):
    items = spark.createDataFrame([("o1", "s1", "c_sp"), ("o2", "s1", "c_rj"), ("o3", "s1", "c_ba"),
                                   ("o4", "s1", "c_null"), ("o4", "s1", "c_null")],
                                  "order_key string, seller_key string, customer_key string")
    sellers = spark.createDataFrame([("s1", "campinas", "SP", -22.9, -47.0)],
                                    "seller_key string, city string, state string, latitude double, longitude double")
    customers = spark.createDataFrame([("c_sp", "x", "SP", -23.0, -46.0), ("c_rj", "x", "RJ", -22.0, -43.0),
                                       ("c_ba", "x", "BA", -12.0, -38.0), ("c_null", "x", "MG", None, -44.0)],
                                      "customer_key string, city string, state string, latitude double, longitude double")
    out = {r.order_key: r for r in gold.spatial_routing(items, sellers, customers).collect()}
    assert set(out) == {"o1", "o2", "o3"}
    assert out["o3"].hub_name == "Sao Paulo Hub" and out["o3"].hub_lat == -23.5505
    assert out["o2"].hub_name == "Rio de Janeiro Hub"
    assert gold.spatial_routing(items, sellers, customers, n=2).count() == 2


def test_customer_cohorts_new_and_returning(spark):
    from marketlake.plans.core import dim_dates, fixed_bounds
    orders = spark.createDataFrame([
        ("o1", "k1", D(2018, 1, 5, 9), 10.0), ("o2", "k1", D(2018, 1, 5, 18), 20.0),   # two orders on day one: both New
        ("o3", "k2", D(2018, 1, 20), 5.0),                                           # same human, other key: Returning
        ("o4", "k3", D(2030, 1, 1), 7.0)],                                           # outside the calendar
        "order_key string, customer_key string, purchased_at timestamp_ntz, total_order_value double")
    customers = spark.createDataFrame([("k1", "h1"), ("k2", "h1"), ("k3", "h2")], "customer_key string, customer_unique_id string")
    out = gold.customer_cohorts(orders, customers, dim_dates(fixed_bounds(spark))).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.total_unique_buyers, r.new_buyers_count, r.returning_buyers_count, r.total_orders) == (1, 1, 1, 3)
    assert (r.total_gmv, r.new_buyer_gmv, r.returning_buyer_gmv) == (35.0, 30.0, 5.0)
    assert r.repeat_buyer_rate_pct == 100.0 and r.avg_days_since_first_purchase == 15.0


def test_payment_analysis_repeats_gmv_per_payment(spark):
    pay = spark.createDataFrame([("o1", "credit_card", 2, 60.0), ("o1", "credit_card", 1, 40.0), ("o9", "credit_card", 1, 5.0)],
                                "order_key string, payment_type string, installment_count int, payment_amount double")
    orders = spark.createDataFrame([("o1", 100.0)], "order_key string, total_order_value double")
    r = gold.payment_analysis(pay, orders).first()
    assert (r.total_orders_using_payment_type, r.total_payment_transactions) == (2, 3)
    assert r.total_associated_order_gmv == 200.0                  # repeated for each payment row
    assert r.payment_reconciliation_discrepancy == -95.0
    assert r.avg_installment_count == 1.3 and r.avg_payment_transaction_value == 35.0
    d = gold.payment_analysis(pay, orders, dedupe_orders=True).first()
    assert (d.total_associated_order_gmv, d.payment_reconciliation_discrepancy) == (100.0, 5.0)
    assert d.total_payment_transactions == 3


def test_category_performance_distinct_review_average(spark):
    items = spark.createDataFrame([("o1", "p1", 10.0, 1.0, 11.0), ("o1", "p1", 10.0, 1.0, 11.0), ("o2", "p1", 5.0, 0.5, 5.5)],
                                  "order_key string, product_key string, price double, freight_value double, total_item_value double")
    products = spark.createDataFrame([("p1", "toys")], "product_key string, category_name string")
    reviews = spark.createDataFrame([("o1", 5), ("o2", 2)], "order_key string, review_score int")
    r = gold.category_performance(items, products, reviews).first()
    assert (r.units_sold, r.total_orders, r.total_category_revenue) == (3, 2, 27.5)
    assert r.avg_review_score == 3.5                               # per order, not per line
    assert r.revenue_per_unit == 9.17


def test_customer_cohorts_on_dirty_rows(spark):
    """Duplicated order rows, a buyer without id, a null purchase date."""
    from marketlake.plans.core import dim_dates, fixed_bounds
    orders_rows = [("o1", "k1", D(2018, 1, 5, 9), 10.0), ("o1", "k1", D(2018, 1, 5, 9), 10.0),
                   ("o2", "k2", D(2018, 2, 7), 5.5), ("o3", "k3", D(2018, 2, 9), 7.25),
                   ("o4", "k1", None, 3.0), ("o5", "k4", D(2018, 3, 1), 1.0), ("o6", "k3", D(2018, 1, 2), 2.0)]
    cust_rows = [("k1", "h1"), ("k2", "h1"), ("k3", "h2"), ("k4", None)]
    orders = spark.createDataFrame(orders_rows, "order_key string, customer_key string, "
                                                "purchased_at timestamp_ntz, total_order_value double")
    customers = spark.createDataFrame(cust_rows, "customer_key string, customer_unique_id string")
    got = sorted(tuple(r) for r in gold.customer_cohorts(orders, customers,
                                                         dim_dates(fixed_bounds(spark))).collect())
    # first days: h1 5 January, h2 2 January; h1 comes back after 33 days, h2 after 38
    assert got == [(2018, 1, "January", "Q1-2018", 2, 2, 0, 2, 22.0, 22.0, 0.0, 0.0, None),
                   (2018, 2, "February", "Q1-2018", 2, 0, 2, 2, 12.75, 0.0, 12.75, 100.0, 35.5)]
    jan = [r for r in got if r[1] == 1][0]
    assert jan[7] == 2 and jan[8] == 22.0        # o1 counted once as an order, twice in GMV


def test_payment_analysis_on_dirty_rows(spark):
    pay_rows = [("o1", "credit_card", 2, 60.0), ("o1", "credit_card", 1, 40.0), ("o1", "voucher", 1, 10.0),
                ("o2", "boleto", None, None), ("o9", "boleto", 1, 5.0), (None, "boleto", 3, 1.25)]
    order_rows = [("o1", 100.0), ("o1", 100.0), ("o2", 33.33)]          # o1 duplicated
    pay = spark.createDataFrame(pay_rows, "order_key string, payment_type string, installment_count int, "
                                          "payment_amount double")
    orders = spark.createDataFrame(order_rows, "order_key string, total_order_value double")
    cols = ["payment_type", "total_orders_using_payment_type", "total_payment_transactions",
            "avg_installment_count", "total_captured_payment_value", "avg_payment_transaction_value",
            "total_associated_order_gmv", "payment_reconciliation_discrepancy"]
    got = sorted(tuple(r[c] for c in cols) for r in gold.payment_analysis(pay, orders).collect())
    # every payment of o1 meets two order rows; 6.25 / 2 = 3.125
    assert got == [("boleto", 2, 3, 2.0, 6.25, 3.13, 33.33, -27.08),
                   ("credit_card", 1, 4, 1.5, 200.0, 50.0, 400.0, -200.0),
                   ("voucher", 1, 2, 1.0, 20.0, 10.0, 200.0, -180.0)]


def test_regional_logistics_on_dirty_rows(spark):
    item_rows = [("o1", "s1", "c1", 10.0), ("o1", "s1", "c1", 10.0), ("o1", "s1", "c1", 12.5),
                 ("o2", "s2", "c1", 7.25), ("o3", "s1", "c2", 3.0), ("o4", "s3", "c1", 1.0), ("o5", "s1", "c1", None)]
    order_rows = [("o1", 10, "Late", D(2018, 1, 11)), ("o2", None, "In Flight", None),
                  ("o3", 4, "On Time / Early", D(2018, 1, 5)), ("o4", 3, "Late", D(2018, 1, 4)),
                  ("o5", 2, "On Time / Early", D(2018, 1, 3))]
    seller_rows = [("s1", "SP"), ("s2", "RJ"), ("s3", None)]
    customer_rows = [("c1", "MG"), ("c2", "SP")]
    items = spark.createDataFrame(item_rows, "order_key string, seller_key string, customer_key string, freight_value double")
    orders = spark.createDataFrame(order_rows, "order_key string, actual_delivery_days int, "
                                               "delivery_performance_status string, delivered_to_customer_at timestamp_ntz")
    sellers = spark.createDataFrame(seller_rows, "seller_key string, state string")
    customers = spark.createDataFrame(customer_rows, "customer_key string, state string")
    cols = ["origin_state", "destination_state", "total_orders_shipped", "fulfilled_orders_count",
            "sla_breach_rate_pct", "avg_delivery_days", "avg_freight_cost_per_item"]
    got = sorted(tuple(r[c] for c in cols) for r in gold.regional_logistics(items, orders, sellers, customers).collect())
    # o1 has two different freights, its repeated line counts once; o5 has none
    assert got == [("RJ", "MG", 1, 0, None, None, 7.25), ("SP", "MG", 2, 3, 66.67, 7.3, 11.25), ("SP", "SP", 1, 1, 0.0, 4.0, 3.0)]


def test_seller_scorecard_on_dirty_rows(spark):
    item_rows = [("o1", "s1", "c1", 11.0), ("o1", "s1", "c1", 5.5), ("o2", "s1", "c2", 3.25),
                 ("o3", "s2", "c9", 8.0), ("o4", "s2", "c3", 1.0)]
    perf_rows = [("s1", 2, 1, 4.5), ("s2", 2, 2, 3.0)]
    seller_rows = [("s1", "campinas", "SP", -22.9, -47.0), ("s2", "rio", "RJ", None, None), ("s3", "bh", "MG", 1.0, 1.0)]
    customer_rows = [("c1", "h1"), ("c2", "h1"), ("c3", "h2"), ("c3", "h2")]          # c9 missing, c3 duplicated
    review_rows = [("o1", 5), ("o1", 5), ("o1", 3), ("o3", 1)]
    items = spark.createDataFrame(item_rows, "order_key string, seller_key string, customer_key string, total_item_value double")
    perf = spark.createDataFrame(perf_rows, "seller_key string, historical_orders_handled long, "
                                            "unique_products_cataloged long, merchant_avg_delivery_days double")
    sellers = spark.createDataFrame(seller_rows, "seller_key string, city string, state string, latitude double, longitude double")
    customers = spark.createDataFrame(customer_rows, "customer_key string, customer_unique_id string")
    reviews = spark.createDataFrame(review_rows, "order_key string, review_score int")
    cols = ["seller_key", "unique_buyers_served", "total_items_sold", "total_gross_revenue", "avg_review_score"]
    got = sorted(tuple(r[c] for c in cols)
                 for r in gold.seller_scorecard(perf, sellers, items, customers, reviews).collect())
    # o3's buyer is unknown, o4's is there twice; s3 sold nothing
    assert got == [("s1", 1, 3, 19.75, 4.0), ("s2", 1, 2, 2.0, 1.0)]


def test_category_performance_on_dirty_rows(spark):
    item_rows = [("o1", "p1", 10.0, 1.0), ("o1", "p2", 4.5, 0.5), ("o2", "p1", 10.0, 1.25), ("o3", "p3", 2.0, 0.2),
                 ("o4", "p9", 1.0, 0.1), (None, "p2", 3.0, 0.3), ("o5", "p2", 2.5, None)]
    product_rows = [("p1", "toys"), ("p2", "toys"), ("p3", "books"), ("p3", "books")]   # p9 missing, p3 duplicated
    review_rows = [("o1", 4), ("o1", 4), ("o2", 1), ("o3", 5), ("o3", 2)]
    items = spark.createDataFrame([(o, p, pr, fr, None if fr is None else pr + fr) for o, p, pr, fr in item_rows],
                                  "order_key string, product_key string, price double, freight_value double, "
                                  "total_item_value double")
    products = spark.createDataFrame(product_rows, "product_key string, category_name string")
    reviews = spark.createDataFrame(review_rows, "order_key string, review_score int")
    got = sorted(tuple(r) for r in gold.category_performance(items, products, reviews).collect())
    # p3 is there twice, the line without an order counts as a unit, the one without freight has no total
    assert got == [("books", 4.4, 4.0, 0.4, 2, 1, 2.2, 0.2, 3.5), ("toys", 30.55, 30.0, 3.05, 5, 3, 6.11, 0.61, 2.5)]


def test_orders_and_what_if_on_dirty_rows(spark):
    from marketlake.plans import core
    order_rows = [("o1", "c1", "delivered", D(2018, 1, 1), D(2018, 1, 11), D(2018, 1, 20)),
                  ("o1", "c1", "delivered", D(2018, 1, 1), D(2018, 1, 11), D(2018, 1, 20)),
                  ("o2", "c2", "delivered", D(2018, 1, 10), D(2018, 1, 7), D(2018, 1, 12)),      # delivered before purchase
                  ("o3", "c1", "canceled", D(2018, 2, 1), None, D(2018, 2, 9)),
                  ("o4", "c9", "delivered", D(2018, 2, 3), D(2018, 3, 30), D(2018, 2, 20))]
    item_rows = [("o1", 1, "p", "s1", 10.0, 3.33), ("o1", 2, "p", "s2", 5.0, None), ("o2", 1, "p", "s1", 7.0, 0.01),
                 ("o4", 1, "p", "s3", 9.0, 2.5), ("o9", 1, "p", "s1", 1.0, 1.0)]
    cust_rows = [("c1", "SP"), ("c2", "RJ"), ("c9", "BA")]
    orders = spark.createDataFrame(
        [(o, c, st, p, None, None, d, e) for o, c, st, p, d, e in order_rows],
        "order_key string, customer_key string, order_status string, purchase_timestamp timestamp_ntz, "
        "approved_at_timestamp timestamp_ntz, delivered_carrier_timestamp timestamp_ntz, "
        "delivered_customer_timestamp timestamp_ntz, estimated_delivery_timestamp timestamp_ntz")
    items = spark.createDataFrame([(o, n, p, s, None, pr, fr) for o, n, p, s, pr, fr in item_rows],
                                  "order_key string, order_item_id int, product_key string, seller_key string, "
                                  "shipping_limit_timestamp timestamp_ntz, price double, freight_value double")
    customers = spark.createDataFrame(cust_rows, "customer_key string, state string")
    fo = core.fct_orders(orders, items)
    fi = core.fct_order_items(items, orders)
    ex = gold.executive_overview(fo, fi, customers)
    cols = ["order_key", "seller_key", "customer_state", "actual_shipping_days", "actual_freight",
            "optimized_shipping_days", "optimized_freight", "days_saved", "freight_dollars_saved", "is_optimized_late"]
    got = sorted(tuple(r[c] for c in cols) for r in ex.collect())
    # o1 is there twice on both sides of the join; 6.5 days round to 7, 1.625 to 1.63
    assert got == [("o1", "s1", "SP", 10, 3.33, 7, 2.16, 3, 1.17, 0)] * 4 + [
        ("o2", "s1", "RJ", -3, 0.01, -3, 0.01, 0, 0.0, 0), ("o4", "s3", "BA", 55, 2.5, 36, 1.63, 19, 0.87, 1)]
    assert any(r[3] == -3 and r[5] == -3 for r in got)            # negative days pass through, as in the source


def test_review_text_signals_on_dirty_text(spark):
    rows = [(5, "ATRASO e demora", 1), (5, "\t", 2), (5, "   ", None), (None, "bad and poor", 3),
            (None, None, 4), (1, "PÉSSIMO", 0), (1, "chocolate broken", 2), (1, "", 1)]
    reviews = spark.createDataFrame(rows, "review_score int, comment_message string, review_response_delay_days int")
    got = sorted((tuple(r) for r in gold.review_text_signals(reviews).collect()),
                 key=lambda t: (t[0] is None, t[0] or 0))
    # a tab is a written comment, "chocolate" holds "late"
    assert got == [(1, 3, 2, 66.67, 1.0, 1, 1, 0), (5, 3, 2, 66.67, 1.5, 1, 0, 0), (None, 2, 1, 50.0, 3.5, 0, 0, 1)]
    assert [t for t in got if t[0] == 1][0][7] == 0              # accented word misses its ASCII stem
