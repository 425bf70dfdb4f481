"""Model DAG: bronze -> staging -> core -> gold, lazily or materialized.

`build_models` wires every model as one lazy plan per table (nothing runs).
`run_pipeline` materializes layer by layer: each layer is written as tables
of a version that readers do not see before it has passed its checks, and the next layer reads the written table back, which
cuts lineage (an executor lost late in the gold layer recomputes from the
core tables, not from the raw files) and lets the scan of a written table
prune columns and push filters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.plans import core, gold
from marketlake.plans.staging import build_staging

CORE = ["dim_customers", "dim_dates", "dim_products", "dim_sellers", "fct_order_items",
        "fct_order_payments", "fct_order_reviews", "fct_orders", "int_seller_performance"]
GOLD = ["gold_category_performance", "gold_customer_cohorts", "gold_executive_overview",
        "gold_payment_analysis", "gold_regional_logistics", "gold_review_text_signals",
        "gold_seller_scorecard", "gold_spatial_routing"]


def build_core(stg: Mapping[str, DataFrame], bounds: DataFrame | None = None) -> dict[str, DataFrame]:
    """Core models from staging.  `bounds` = one-row (start_date, end_date);
    default: whole years spanned by the orders."""
    out: dict[str, DataFrame] = {}
    for name in CORE:
        out[name] = _CORE_BUILDERS[name](stg, bounds, out)
    return out


def _scores(m: Mapping[str, DataFrame]) -> DataFrame:
    """The reviews for marts that need their orders and scores only: the fact keeps every staged review, so its buyers are not looked up."""
    return m["stg_order_reviews" if "stg_order_reviews" in m else "fct_order_reviews"]


def _signals_before_buyers(stg: Mapping[str, DataFrame]) -> DataFrame:
    """The text mart where the review fact is not written: messages become signals before the fact looks its buyers up, so that no text is dealt
    for them.  The rows are the fact's (a review of an order that stands there twice counts twice)."""
    reviews = stg["stg_order_reviews"].withColumn("comment_message", gold.message_signals(F.col("comment_message")))
    return gold.signal_totals(core.fct_order_reviews(reviews, stg["stg_orders"]))


GOLD_BUILDERS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "gold_category_performance": lambda m: gold.category_performance(
        m["fct_order_items"], m["dim_products"], _scores(m)),
    "gold_customer_cohorts": lambda m: gold.customer_cohorts(
        m["fct_orders"], m["dim_customers"], m["dim_dates"]),
    "gold_executive_overview": lambda m: gold.executive_overview(
        m["fct_orders"], m["fct_order_items"], m["dim_customers"]),
    "gold_payment_analysis": lambda m: gold.payment_analysis(
        m["fct_order_payments"], m["fct_orders"]),
    "gold_regional_logistics": lambda m: gold.regional_logistics(
        m["fct_order_items"], m["fct_orders"], m["dim_sellers"], m["dim_customers"]),
    "gold_review_text_signals": lambda m: gold.review_text_signals(m["fct_order_reviews"]),
    "gold_seller_scorecard": lambda m: gold.seller_scorecard(
        m["int_seller_performance"], m["dim_sellers"], m["fct_order_items"],
        m["dim_customers"], _scores(m)),
    "gold_spatial_routing": lambda m: gold.spatial_routing(
        m["fct_order_items"], m["dim_sellers"], m["dim_customers"]),
}


def build_gold(core_models: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: GOLD_BUILDERS[name](core_models) for name in GOLD}


def build_models(bronze: Mapping[str, DataFrame], bounds: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every staging, core and gold model as a lazy DataFrame."""
    stg = build_staging(dict(bronze))
    cm = build_core(stg, bounds)
    return {**stg, **cm, **build_gold(cm)}


class Models(Mapping):
    """Models built on first access (each DataFrame is still lazy).

    Building a DataFrame analyzes its plan; a query that needs three tables
    should not pay for analyzing all twenty-six.
    """

    def __init__(self, bronze: Mapping[str, DataFrame], bounds: DataFrame | None = None):
        self.bronze = bronze  # may be lazy: sources are built on first use
        self._bounds = bounds
        self._cache: dict[str, DataFrame] = {}

    def _build(self, name: str) -> DataFrame:
        from marketlake.plans.staging import STAGING
        if name in STAGING:
            src, fn = STAGING[name]
            return fn(self.bronze[src])
        stg = _StagingView(self)
        if name in CORE:
            return _CORE_BUILDERS[name](stg, self._bounds, self)
        if name == "gold_review_text_signals":
            return _signals_before_buyers(stg)
        if name in GOLD_BUILDERS:
            return GOLD_BUILDERS[name](self)
        raise KeyError(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def __iter__(self):
        from marketlake.plans.staging import STAGING
        return iter([*STAGING, *CORE, *GOLD])

    def __len__(self) -> int:
        return len(list(iter(self)))


class _StagingView:
    def __init__(self, models: Models):
        self.models = models

    def __getitem__(self, name: str) -> DataFrame:
        return self.models[name]


_CORE_BUILDERS = {
    "dim_customers": lambda s, b, m: core.dim_customers(s["stg_customers"], s["stg_geolocation"]),
    "dim_dates": lambda s, b, m: core.dim_dates(b if b is not None else core.data_bounds(s["stg_orders"])),
    "dim_products": lambda s, b, m: core.dim_products(s["stg_products"], s["stg_category_translation"]),
    "dim_sellers": lambda s, b, m: core.dim_sellers(s["stg_sellers"], s["stg_geolocation"]),
    "fct_order_items": lambda s, b, m: core.fct_order_items(s["stg_order_items"], s["stg_orders"]),
    "fct_order_payments": lambda s, b, m: core.fct_order_payments(s["stg_order_payments"]),
    "fct_order_reviews": lambda s, b, m: core.fct_order_reviews(s["stg_order_reviews"], s["stg_orders"]),
    "fct_orders": lambda s, b, m: core.fct_orders(s["stg_orders"], s["stg_order_items"]),
    "int_seller_performance": lambda s, b, m: core.int_seller_performance(
        m["fct_order_items"], m["fct_orders"]),
}


# Order-grain tables that `run_pipeline(buckets=N)` buckets by order_key with one
# bucket count, so that the order_key joins and aggregations of the next layer
# need no shuffle.
ORDER_BUCKETED = ("stg_order_items", "stg_orders", "stg_order_reviews", "stg_order_payments",
                  "fct_order_items", "fct_orders", "fct_order_reviews", "fct_order_payments")


class _InPlace:
    """Tables of a format with transactions of its own, written where readers find them."""

    def __init__(self, root: str, fmt: str):
        self.root, self.fmt = root.rstrip("/"), fmt
        self.folder = self.root

    def write(self, name: str, df: DataFrame, **options) -> DataFrame:
        from marketlake.sources.sinks import write_table
        return write_table(df, f"{self.root}/{name}", self.fmt, **options)

    def commit(self) -> None:
        """Nothing to do: each table's write was its own transaction."""


Counts = dict[str, dict[str, int]]


def _materialize(refresh, models: Mapping[str, DataFrame], buckets: int | None, parallel: int = 1,
                 measure: bool = False) -> tuple[dict[str, DataFrame], Counts]:
    """Write the models of one layer; they are independent, so up to
    `parallel` write jobs are submitted at once (Spark runs jobs from several
    driver threads concurrently, filling executors during each job's tail).
    With `measure`, also the counts of each model's `row_metrics`."""
    from concurrent.futures import ThreadPoolExecutor

    from marketlake.plans.quality import row_metrics

    def write(item):
        name, df = item
        bucket = ("order_key", buckets) if buckets and name in ORDER_BUCKETED else None
        metrics = row_metrics(name) if measure else []
        seen = Observation(name) if metrics else None
        table = refresh.write(name, df, bucket_by=bucket, observe=(seen, metrics) if seen else None,
                              table=f"{name}_{hashlib.sha256(refresh.folder.encode()).hexdigest()[:8]}")
        return name, table, seen.get if seen else {}

    if parallel <= 1:
        done = list(map(write, models.items()))
    else:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            done = list(pool.map(write, models.items()))
    return {n: t for n, t, _ in done}, {n: c for n, _, c in done if c}


Layer = Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]


def publish(spark: SparkSession, layers: Sequence[Layer], out_dir: str, fmt: str | None = None, checks: bool = True,
            gate: bool = True, buckets: int = 0, parallel: int = 4) -> dict[str, DataFrame]:
    """Write the tables of each layer, built from the layers before it, check them, and publish all of them at once.

    Tables go into a version folder that no reader sees (`sources.lake`).  Checks of single rows are counted by the writes
    themselves, unique keys from that version's key columns (with Delta, all checks read the tables); only
    if they pass (or without `gate`) is it committed.  A build that fails in a task, is killed, or fails a check
    leaves every published table as it was; `QualityError` then names the folder with the refused tables and their report.
    """
    from marketlake.plans.quality import QualityError, assert_passed, measured_report, run_checks
    from marketlake.sources.lake import Lake
    from marketlake.sources.sinks import default_format
    fmt = fmt or default_format(spark)
    refresh = _InPlace(out_dir, fmt) if fmt == "delta" else Lake(spark, out_dir, fmt).refresh()
    tables: dict[str, DataFrame] = {}
    counts: Counts = {}
    measure = checks and fmt != "delta"
    for layer in layers:
        written, seen = _materialize(refresh, layer(tables), buckets, parallel, measure)
        tables.update(written)
        counts.update(seen)
    if checks:
        report = measured_report(spark, counts, tables) if measure else run_checks(tables)
        tables["quality_report"] = refresh.write("quality_report", report)
        if gate:
            try:
                assert_passed(tables["quality_report"])
            except QualityError as exc:
                raise QualityError(f"{exc} (not published: {refresh.folder})") from None
    refresh.commit()
    return tables


def run_pipeline(spark: SparkSession, bronze: Mapping[str, DataFrame], out_dir: str,
                 bounds: DataFrame | None = None, fmt: str | None = None,
                 checks: bool = True, gate: bool = True,
                 buckets: int = 0, parallel: int = 4) -> dict[str, DataFrame]:
    """Build every model layer by layer, run the quality suite on what was written, and publish (see `publish`).

    Returns the written tables (as DataFrames reading them back) plus
    `quality_report`.  With `gate`, raises `QualityError` when any check
    fails, and nothing is published.

    `buckets=N` writes the order-grain tables bucketed by order_key, which
    removes the order_key shuffles of the next layer.  It is off by default:
    a bucket holds every row of its keys, so an order holding a large share of
    all lines would pin that share to one task in each co-partitioned join,
    where adaptive skew splitting (which works on shuffled joins) cannot help.
    Enable it when order keys are known to be spread.  `parallel` bounds the
    number of write jobs of one layer submitted at once.
    """
    def facts(t):
        return {n: df for n, df in build_core(t, bounds).items() if n != "int_seller_performance"}

    def sellers(t):           # from the written facts, which it would else build anew
        return {"int_seller_performance": _CORE_BUILDERS["int_seller_performance"](t, bounds, t)}

    layers = [lambda t: build_staging(dict(bronze)), facts, sellers, build_gold]
    return publish(spark, layers, out_dir, fmt, checks, gate, buckets, parallel)
