"""Every check type passes on clean data and fails on a bad row."""
import pytest

from marketlake.plans import quality


def _report(spark, models):
    return {r.check_name: r.violations for r in quality.run_checks(models).collect()}


def test_checks_detect_violations(spark):
    orders_ok = spark.createDataFrame([("o1", "c1", "Late"), ("o2", "c1", "In Flight")],
                                      "order_key string, customer_key string, delivery_performance_status string")
    orders_bad = spark.createDataFrame([("o1", "c1", "Late"), ("o1", None, "Lost"), (None, "c", "Meh"), ("o3", "c", "Meh")],
                                       "order_key string, customer_key string, delivery_performance_status string")
    ok = _report(spark, {"fct_orders": orders_ok})
    assert set(ok.values()) == {0} and len(ok) == 4
    bad = _report(spark, {"fct_orders": orders_bad})
    assert bad["unique__fct_orders__order_key"] == 1
    assert bad["not_null__fct_orders__order_key"] == 1
    assert bad["not_null__fct_orders__customer_key"] == 1
    assert bad["accepted_values__fct_orders__delivery_performance_status"] == 2


def test_invariant_and_gate(spark):
    ex = spark.createDataFrame([("o1", "SP", 5, 10.0, 6, 6.5), ("o2", "SP", 5, 10.0, 3, -1.0)],
                               "order_key string, customer_state string, actual_shipping_days int, actual_freight double, "
                               "optimized_shipping_days int, optimized_freight double")
    report = quality.run_checks({"gold_executive_overview": ex})
    got = {r.check_name: r.violations for r in report.collect()}
    assert got["valid_optimizer_outputs__gold_executive_overview__*"] == 2
    with pytest.raises(quality.QualityError):
        quality.assert_passed(report)


def test_check_inventory():
    kinds = [c[2] for c in quality.CHECKS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (65, 18, 1)


def test_full_report_on_smoke_tables_fails_only_the_unparsable_scores(spark):
    import __spark_entry__ as E
    from conftest import SF_SMOKE
    report = E.queries()["quality_report"](spark, SF_SMOKE).collect()
    assert len(report) == 85
    failed = {r.check_name for r in report if r.violations > 0}
    assert failed == {"not_null__stg_order_reviews__review_score",
                      "not_null__gold_review_text_signals__review_score"}


def test_accounting_invariants_on_smoke_tables(spark):
    from pyspark.sql import functions as F

    from conftest import SF_SMOKE
    from marketlake.plans.registry import models
    m = models(spark, SF_SMOKE)
    cohorts = m["gold_customer_cohorts"]
    assert cohorts.filter(F.abs(F.col("new_buyer_gmv") + F.col("returning_buyer_gmv") - F.col("total_gmv"))
                          > 0.005).count() == 0
    categories = m["gold_category_performance"]
    assert categories.filter(F.abs(F.col("total_merchandise_revenue") + F.col("total_freight_revenue")
                                   - F.col("total_category_revenue")) > 0.005).count() == 0
    executive = m["gold_executive_overview"]
    assert executive.filter((F.col("actual_shipping_days") >= 0) & (F.col("days_saved") < 0)).count() == 0
    assert executive.filter(F.col("optimized_freight") > F.col("actual_freight")).count() == 0
    # every order's value equals its items' value (orders with items) and 0 otherwise
    orders, items = m["fct_orders"], m["fct_order_items"]
    per_order = items.groupBy("order_key").agg(F.sum("total_item_value").alias("v"))
    diff = orders.join(per_order, "order_key", "left").filter(
        F.abs(F.coalesce("v", F.lit(0.0)) - F.col("total_order_value")) > 0.005)
    assert diff.count() == 0


BAD_ORDERS = [("o1", "c1", "Late"), ("o1", None, "Lost"), (None, "c", "Meh"), ("o3", "c", "Meh"), ("o4", "c", None)]


@pytest.mark.parametrize("buckets", [0, 3])
def test_checks_measured_by_the_writes(spark, tmpdir_fresh, buckets):
    from marketlake.plans.build import publish
    orders = spark.createDataFrame(BAD_ORDERS, "order_key string, customer_key string, delivery_performance_status string")
    ex = spark.createDataFrame([("o1", "SP", 5, 10.0, 6, 6.5), (None, "SP", 5, 10.0, 3, -1.0), ("o3", None, 5, 10.0, 5, 1.0)],
                               "order_key string, customer_state string, actual_shipping_days int, actual_freight double, "
                               "optimized_shipping_days int, optimized_freight double")
    layers = [lambda t: {"fct_orders": orders.repartition(3), "stg_sellers": spark.createDataFrame([], "seller_key string")},
              lambda t: {"gold_executive_overview": ex, "unchecked": t["fct_orders"]}]
    tables = publish(spark, layers, tmpdir_fresh, "parquet", gate=False, buckets=buckets)
    report = tables.pop("quality_report")
    assert sorted(report.collect()) == sorted(quality.run_checks(tables).collect())
    got = {r.check_name: r.violations for r in report.collect()}
    assert got["accepted_values__fct_orders__delivery_performance_status"] == 2 and got["unique__fct_orders__order_key"] == 1
    assert got["valid_optimizer_outputs__gold_executive_overview__*"] == 2 and got["unique__stg_sellers__seller_key"] == 0


def test_measured_report_reads_only_keys(spark):
    """Clean tables are read for their unique keys alone, in one exchange of keys."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr(
        "string(o_orderkey) order_key", "string(o_custkey) customer_key", "'Late' delivery_performance_status")
    place = __import__("tempfile").mkdtemp(prefix="marketlake-test-")
    orders.write.parquet(f"{place}/orders")
    table = spark.read.parquet(f"{place}/orders")
    counts = {"fct_orders": {n: 0 for n in quality._row_checks("fct_orders")}, "stg_orders": {n: 0 for n in quality._row_checks("stg_orders")}}
    report = quality.measured_report(spark, counts, {"fct_orders": table, "stg_orders": table})
    plan = report._jdf.queryExecution().executedPlan().toString()
    schemas = {s.split(">")[0] for s in plan.split("ReadSchema: struct<")[1:]}
    assert schemas == {"order_key:string"} and plan.count("hashpartitioning(check") == 1
    assert {r.violations for r in report.collect()} == {0} and report.count() == 7


def test_report_deals_no_message_of_a_single_version(spark, tmpdir_fresh):
    """Messages cross no exchange but that of reviews with several versions, neither for the report nor for the text mart."""
    from pyspark.sql import functions as F

    from conftest import settings
    from marketlake.plans.build import Models
    from test_plans import _shuffle_bytes
    texts = F.concat(*[F.sha2(F.concat("id", F.lit(f"/{i}")).cast("string"), 512) for i in range(20)])
    key = F.when(F.col("id") < 3, F.lit("twice")).otherwise(F.concat(F.lit("r"), F.col("id").cast("string")))
    order = (F.col("id") % 40).cast("string")
    spark.range(0, 600, 1, 4).select(
        key.alias("review_id"), order.alias("order_id"), F.lit("4").alias("review_score"), F.lit(None).cast("string").alias("review_comment_title"),
        texts.alias("review_comment_message"), F.lit("2018-01-02 00:00:00").alias("review_creation_date"),
        F.lit("2018-01-03 00:00:00").alias("review_answer_timestamp")).write.parquet(f"{tmpdir_fresh}/r")
    raw = spark.read.parquet(f"{tmpdir_fresh}/r")
    orders = spark.range(30).select(F.col("id").cast("string").alias("order_id"), F.lit("c").alias("customer_id"), F.lit("delivered").alias("order_status"), *[
        F.lit("2018-01-01 00:00:00").alias(c) for c in ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                                                        "order_delivered_customer_date", "order_estimated_delivery_date")])
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        m = Models({"order_reviews": raw, "orders": orders.unionByName(orders.where("order_id = '7'"))})
        marts = ("stg_order_reviews", "fct_order_reviews", "gold_review_text_signals")
        report = quality.run_checks({n: m[n] for n in marts})
        got = {r.check_name: r.violations for r in report.collect()}
        moved = _shuffle_bytes(report._jdf.queryExecution().executedPlan())
        mart = m["gold_review_text_signals"].first()
    assert set(got.values()) == {0, 15} and got["unique__fct_order_reviews__review_key"] == 15      # the reviews of order 7, which stands there twice
    assert (mart.total_reviews_count, mart.reviews_with_written_comments_count) == (613, 613)
    assert moved < 300_000                      # the messages of 600 reviews are 1.5 MB


def test_sellers_are_built_from_written_facts(spark, tmpdir_fresh, monkeypatch):
    from conftest import SF_SMOKE
    from marketlake.plans import core
    from marketlake.plans.build import run_pipeline
    from marketlake.sources.testdata import bronze_from_testdata
    model, read = core.int_seller_performance, []

    def seen(items, orders):
        read.append([{f.split("/")[-2] for f in df.inputFiles()} for df in (items, orders)])
        return model(items, orders)
    monkeypatch.setattr(core, "int_seller_performance", seen)
    tables = run_pipeline(spark, bronze_from_testdata(spark, SF_SMOKE), tmpdir_fresh, gate=False)
    assert [{"fct_order_items"}, {"fct_orders"}] in read and tables["int_seller_performance"].count() > 0
