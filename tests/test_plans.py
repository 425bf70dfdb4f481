"""Physical-plan properties that matter at scale."""
import os

import pytest

import __spark_entry__ as E
from conftest import SF_SMOKE, settings

from marketlake.plans import scenario
from marketlake.plans.registry import QUERIES, models


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"bronze_manifest"}))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMOKE))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_dedup_uses_partial_window_group_limit(spark):
    plan = _plan(models(spark, SF_SMOKE)["stg_order_reviews"])
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_items_are_aggregated_before_the_order_join(spark):
    plan = _plan(models(spark, SF_SMOKE)["fct_orders"])
    join_at = min(i for i in (plan.find("SortMergeJoin"), plan.find("BroadcastHashJoin")) if i >= 0)
    assert plan.find("HashAggregate", join_at) > join_at       # the aggregate sits below the join


def test_scan_reads_only_needed_columns(spark):
    df = models(spark, SF_SMOKE)["gold_executive_overview"]
    plan = _plan(df)
    lineitem_scan = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    assert "l_comment" not in lineitem_scan and "l_partkey" not in lineitem_scan


def _formatted(spark, df) -> str:
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_scenario_filter_pushes_into_gold_table_scan(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "exec")
    models(spark, SF_SMOKE)["gold_executive_overview"].write.parquet(path)
    gold = spark.read.parquet(path)
    text = _formatted(spark, scenario.scenario_kpis(scenario.scenario_filter(gold, states=["RJ", "SP"], max_days=30)))
    pushed = [line for line in text.splitlines() if line.strip().startswith("PushedFilters")][0]
    assert "In(customer_state, [RJ,SP])" in pushed
    assert "LessThanOrEqual(optimized_shipping_days,30)" in pushed
    schema = [line for line in text.splitlines() if line.strip().startswith("ReadSchema")][0]
    assert "purchased_at" not in schema and "seller_key" not in schema   # KPIs prune unused columns


def test_bucketed_build_joins_without_shuffle(spark, tmpdir_fresh):
    from marketlake.plans import gold
    from marketlake.plans.build import run_pipeline
    from marketlake.sources.testdata import bronze_from_testdata
    tables = run_pipeline(spark, bronze_from_testdata(spark, SF_SMOKE), tmpdir_fresh, gate=False, buckets=4)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    with settings(spark, dict.fromkeys(keys, "-1")):  # behave as at scale: no side is small
        ex = gold.executive_overview(tables["fct_orders"], tables["fct_order_items"], tables["dim_customers"])
        plan = spark._jvm.PythonSQLUtils.explainString(ex._jdf.queryExecution(), "simple")
    assert "Bucketed: true" in plan
    assert "hashpartitioning(order_key" not in plan    # the order_key join reads co-partitioned buckets
    assert "hashpartitioning(customer_key" in plan     # the customer join still shuffles


def test_hot_order_key_is_split_by_adaptive_skew_join(spark):
    """One order holds a third of all lines: the shuffled join splits it."""
    from pyspark.sql import functions as F

    from marketlake.plans import core
    n = 30000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("order_key"),
        F.lit(1).alias("order_item_id"), F.lit("p").alias("product_key"), F.lit("s").alias("seller_key"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_timestamp"),
        (F.rand(7) * 100).alias("price"), F.rand(8).alias("freight_value"))   # incompressible payload
    orders = spark.range(n).select(
        F.when(F.col("id") == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("order_key"),
        F.lit("c").alias("customer_key"), F.lit("delivered").alias("order_status"),
        F.lit(None).cast("timestamp_ntz").alias("purchase_timestamp"))
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                "spark.sql.shuffle.partitions": "8"}
    with settings(spark, values):
        df = core.fct_order_items(items, orders)
        assert len(df.collect()) == n                 # runs this plan; AQE finalizes it
        final = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin" in final and "skew=true" in final


def test_concurrent_layered_build_equals_lazy_models(spark, tmpdir_fresh):
    from marketlake.plans.build import GOLD, run_pipeline
    from marketlake.sources.testdata import bronze_from_testdata
    built = run_pipeline(spark, bronze_from_testdata(spark, SF_SMOKE), tmpdir_fresh, gate=False, parallel=4)
    lazy = models(spark, SF_SMOKE)
    for name in [*GOLD, "fct_orders", "stg_order_reviews"]:
        a, b = built[name], lazy[name].select(*built[name].columns)
        assert a.count() == b.count()
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def _shuffle_bytes(plan) -> int:
    """Bytes written by every shuffle in an executed (adaptive) plan."""
    cls = plan.getClass().getSimpleName()
    inner = plan.executedPlan() if cls == "AdaptiveSparkPlanExec" else plan.plan() if cls.endswith("QueryStageExec") else None
    children = plan.children()
    return (int(plan.metrics().apply("shuffleBytesWritten").value()) if cls == "ShuffleExchangeExec" else 0) + (
        _shuffle_bytes(inner) if inner is not None else 0) + sum(_shuffle_bytes(children.apply(i)) for i in range(children.size()))


def _shuffle_records(plan) -> list[int]:
    """`records written` of every shuffle in an executed (adaptive) plan."""
    out = []
    cls = plan.getClass().getSimpleName()
    if cls == "AdaptiveSparkPlanExec":
        out += _shuffle_records(plan.executedPlan())
    if cls.endswith("QueryStageExec"):
        out += _shuffle_records(plan.plan())
    if cls == "ShuffleExchangeExec":
        out.append(int(plan.metrics().apply("shuffleRecordsWritten").value()))
    children = plan.children()
    for i in range(children.size()):
        out += _shuffle_records(children.apply(i))
    return out


def test_hot_dedup_key_is_cut_before_the_shuffle(spark):
    """A key holding a third of the rows crosses the shuffle once per map task."""
    from pyspark.sql import functions as F

    from marketlake.operators import keep_first
    n, tasks = 30000, 6
    df = spark.range(0, n, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 97).alias("t"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], [F.col("t").desc()])
    rows = out.collect()
    assert len(rows) == n - n // 3 + 1
    assert _shuffle_records(out._jdf.queryExecution().executedPlan()) == [n - n // 3 + tasks]


def _window_input_records(plan, under_window=False) -> list[int]:
    """Records written by the first shuffle below each Window operator."""
    out = []
    cls = plan.getClass().getSimpleName()
    if cls == "AdaptiveSparkPlanExec":
        return _window_input_records(plan.executedPlan(), under_window)
    if cls.endswith("QueryStageExec"):
        return _window_input_records(plan.plan(), under_window)
    if cls == "ShuffleExchangeExec" and under_window:
        return [int(plan.metrics().apply("shuffleRecordsWritten").value())]
    is_window = cls == "WindowExec"
    children = plan.children()
    for i in range(children.size()):
        out += _window_input_records(children.apply(i), under_window or is_window)
    return out


def test_hot_buyer_reaches_the_cohort_window_once_per_day(spark):
    """A buyer with a third of all orders (on 5 days) adds 5 rows to the window shuffle."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from marketlake.plans import gold
    from marketlake.plans.core import dim_dates, fixed_bounds
    n = 30000
    orders = spark.range(0, n, 1, 6).select(
        F.col("id").cast("string").alias("order_key"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("customer_key"),
        (F.lit(datetime(2018, 1, 1)) + F.make_dt_interval((F.col("id") % 5).cast("int"))).alias("purchased_at"),
        F.lit(1.0).alias("total_order_value"))
    customers = orders.select("customer_key").distinct().select(
        "customer_key", F.concat(F.lit("u-"), "customer_key").alias("customer_unique_id"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    with settings(spark, dict.fromkeys(keys, "-1")):  # as at scale: neither side is broadcast
        out = gold.customer_cohorts(orders, customers, dim_dates(fixed_bounds(spark)))
        assert out.collect()[0].total_orders == n
        records = _window_input_records(out._jdf.queryExecution().executedPlan())
    other_buyers = n - n // 3
    assert records == [other_buyers + 5]


def test_only_the_route_sample_is_limited(spark):
    assert "TakeOrderedAndProject(limit=3000" in _plan(E.queries()["spatial_routing"](spark, SF_SMOKE))
    plan = _plan(models(spark, SF_SMOKE)["gold_spatial_routing"])
    assert not any(limit in plan for limit in ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrdered"))
