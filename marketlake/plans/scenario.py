"""Scenario analytics over the what-if projection and the route sample.

The interactive layer in the source fetched whole gold tables into one
process and filtered there.  Here every step is a Spark plan: filters push
down to the gold table scan, KPIs are one global aggregate, and only the
handful of answer rows ever leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from marketlake.functions.expressions import (
    HUBS, amount_sum, amount_total, count_if, exact_ratio, from_units, hub_for_state, in_units,
)
from marketlake.operators.aggregates import histogram, top_k

DEFAULT_STATE_COUNT = 5
DEFAULT_MAX_DAYS = 30
SLA_DAYS = 20                        # standard service level used for the baseline on-time count
DEFAULT_CENTER = (-22.5, -45.0)      # map centre when no route is selected
HISTOGRAM = (1.5, 0.0, 40.0)         # bin width, start, end


def state_list(executive: DataFrame, default_count: int = DEFAULT_STATE_COUNT) -> DataFrame:
    """Distinct non-null customer states with the default selection flagged
    (the first `default_count` in sort order)."""
    states = executive.select("customer_state").dropna().distinct()
    defaults = default_states(executive, default_count).withColumn("is_default", F.lit(True))
    # `defaults` holds at most `default_count` rows (a limit), so broadcasting it is bounded.
    return (states.join(F.broadcast(defaults), "customer_state", "left")
            .select("customer_state", F.coalesce("is_default", F.lit(False)).alias("is_default")))


def default_states(executive: DataFrame, count: int = DEFAULT_STATE_COUNT) -> DataFrame:
    """First `count` distinct customer states in sort order (<= count rows)."""
    states = executive.select("customer_state").dropna().distinct()
    return top_k(states, [F.col("customer_state")], count)


def _select_states(df: DataFrame, states: Sequence[str] | None) -> DataFrame:
    return df if states is None else df.filter(F.col("customer_state").isin(*states))


def scenario_filter(executive: DataFrame, states: Sequence[str] | None = None,
                    max_days: int = DEFAULT_MAX_DAYS) -> DataFrame:
    """V1: lines in the selected customer states whose optimized transit time
    is within `max_days`.  `states=None` selects all (a caller who wants the
    default selection asks `default_states` for it)."""
    return _select_states(executive, states).filter(
        F.col("optimized_shipping_days") <= max_days)


COORDINATES = ("seller_lat", "seller_lon", "customer_lat", "customer_lon", "hub_lat", "hub_lon")


def coerce_coordinates(routes: DataFrame) -> DataFrame:
    """Coordinates as double, unparsable values -> null (C4); a no-op on
    columns that are already double."""
    return routes.withColumns({c: F.col(c).try_cast("double") for c in COORDINATES if c in routes.columns})


def filter_routes(routes: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """Routes in the selected customer states (same selection as V1), with
    coordinates coerced to double."""
    return coerce_coordinates(_select_states(routes, states))


def scenario_kpis(filtered: DataFrame) -> DataFrame:
    """V2: one row of headline numbers for the filtered what-if lines."""
    base = in_units(amount_sum("actual_freight"))
    opt = in_units(amount_sum("optimized_freight"))
    agg = filtered.agg(
        from_units(base).alias("total_baseline_freight"),
        from_units(opt).alias("total_optimized_freight"),
        from_units(base - opt).alias("freight_savings"),
        F.avg("days_saved").alias("avg_days_saved"),
        F.count(F.lit(1)).alias("n_lines"),
        count_if(F.col("actual_shipping_days") <= SLA_DAYS).alias("baseline_on_time"),
        count_if(F.col("is_optimized_late") == 0).alias("optimized_on_time"))
    return kpi_columns(agg)


def kpi_columns(agg: DataFrame, *keys: str) -> DataFrame:
    """The headline numbers, rates worked out, from their sums and counts."""
    return agg.select(
        *keys, "total_baseline_freight", "total_optimized_freight", "freight_savings",
        F.when(F.col("total_baseline_freight") > 0,
               F.col("freight_savings") / F.col("total_baseline_freight") * 100)
        .otherwise(F.lit(0.0)).alias("freight_savings_pct"),
        "avg_days_saved", "n_lines", "baseline_on_time", "optimized_on_time",
        F.when(F.col("n_lines") > 0,
               (F.col("optimized_on_time") - F.col("baseline_on_time")) / F.col("n_lines") * 100)
        .otherwise(F.lit(0.0)).alias("otif_lift_pct"))


def lead_time_histogram(filtered: DataFrame, width: float = HISTOGRAM[0],
                        lo: float = HISTOGRAM[1], hi: float = HISTOGRAM[2]) -> DataFrame:
    """V3: transit-day histogram of the baseline and optimized series.

    Bin edges run from `lo` in steps of `width` until they reach `hi`; values
    from `lo` up to (not including) the last edge are counted in bins, values below and
    above in one row each.
    """
    return histogram(filtered, {"baseline": F.col("actual_shipping_days"),
                                "optimized": F.col("optimized_shipping_days")}, width, lo, hi)


_HUB_SCHEMA = StructType([
    StructField("hub_name", StringType(), False),
    StructField("hub_lat", DoubleType(), False),
    StructField("hub_lon", DoubleType(), False),
    StructField("capacity", LongType(), False),
])


def hub_table(spark: SparkSession) -> DataFrame:
    """The three regional hubs as a literal table (name, lat, lon, capacity)."""
    return spark.createDataFrame([(h[0], float(h[1]), float(h[2]), h[3]) for h in HUBS], _HUB_SCHEMA)


def hub_load(filtered: DataFrame, hubs: DataFrame | None = None) -> DataFrame:
    """V4: lines handled per hub; states other than RJ and MG (null included)
    go to the Sao Paulo hub.  Every hub appears, with 0 when idle."""
    hubs = hubs if hubs is not None else hub_table(filtered.sparkSession)
    counts = (filtered.select(hub_for_state("customer_state").hub_name.alias("hub_name"))
              .groupBy("hub_name").agg(F.count(F.lit(1)).alias("orders_handled")))
    # `counts` has at most one row per hub name: a bounded broadcast build side.
    return (hubs.join(F.broadcast(counts), "hub_name", "left")
            .select("hub_name", "hub_lat", "hub_lon", "capacity",
                    F.coalesce("orders_handled", F.lit(0)).alias("orders_handled")))


def corridor_top_k(filtered: DataFrame, routes: DataFrame, k: int = 5,
                   match_seller: bool = False) -> DataFrame:
    """V5: busiest (seller state, customer state) corridors of the filtered
    lines matched to routes by order (many-to-many, as in the source), with
    savings; rounding is half-even; ties broken by the state pair.
    `match_seller=True` matches by (order, seller) instead, so an order with
    two sellers no longer mixes their corridors (routes need `seller_key`,
    see `spatial_routing(keys=True)`).

    Each side is first reduced per order (line count and exact sums on
    one side, route count on the other); sums and averages over the
    many-to-many matches are then weighted by the counts.  The result equals
    aggregating the matched rows, without materializing lines x routes rows
    for an order that is hot on both sides.
    """
    on = ["order_key", "seller_key"] if match_seller else ["order_key"]
    lines = (filtered.filter(F.col("customer_state").isNotNull())
             .groupBy(*on, "customer_state").agg(
                 F.count(F.lit(1)).alias("n_lines"),
                 F.sum("days_saved").alias("days"),
                 F.count("days_saved").alias("days_n"),
                 amount_sum("freight_dollars_saved").alias("saved"),
                 amount_sum("actual_freight").alias("actual")))
    legs = (routes.filter(F.col("seller_state").isNotNull())
            .groupBy(*on, "seller_state").agg(F.count(F.lit(1)).alias("n_routes")))
    w = F.col("n_routes")
    saved = from_units(in_units(amount_total("saved", weight=w)))
    actual = from_units(in_units(amount_total("actual", weight=w)))
    corridors = lines.join(legs, on, "inner").groupBy("seller_state", "customer_state").agg(
        F.count_distinct("order_key").alias("total_orders"),
        F.bround(F.sum(F.col("days") * w).cast("double") / F.sum(F.col("days_n") * w), 1)
        .alias("avg_days_saved"),
        F.bround(saved, 2).alias("total_freight_saved"),
        F.bround(saved / actual * 100, 1).alias("freight_pct"))
    order = [F.col("total_orders").desc(), F.col("seller_state"), F.col("customer_state")]
    return top_k(corridors, order, k)


# Display labels of the corridor scorecard, in column order.
CORRIDOR_LABELS = {
    "seller_state": "Origin (Seller)",
    "customer_state": "Destination (Customer)",
    "total_orders": "Orders Handled",
    "avg_days_saved": "Avg Days Saved",
    "total_freight_saved": "Total Saved ($)",
    "freight_pct": "Cost Reduced (%)",
}


def corridor_display(corridors: DataFrame) -> DataFrame:
    """The corridor table with display labels, in display order."""
    return corridors.select(*[F.col(c).alias(label) for c, label in CORRIDOR_LABELS.items()])


def route_centroid(routes: DataFrame, default: tuple[float, float] = DEFAULT_CENTER,
                   selected_states: int | None = None) -> DataFrame:
    """V6: mean customer coordinates of the routes (6 decimals) and the map
    zoom (5 when more than 3 states are selected, else 6); the default centre
    and zoom 5 when there is no route.  Without `selected_states` the customer
    states of the routes are counted."""
    def mean(c: str):
        return exact_ratio(F.sum(F.col(c).cast("decimal(20,10)")), F.count(c), 6)
    n = F.count(F.lit(1))
    chosen = F.count_distinct("customer_state") if selected_states is None else F.lit(selected_states)
    return routes.agg(
        F.coalesce(mean("customer_lat"), F.lit(default[0])).alias("center_lat"),
        F.coalesce(mean("customer_lon"), F.lit(default[1])).alias("center_lon"),
        n.alias("n_routes"),
        F.when((n > 0) & (chosen <= 3), F.lit(6)).otherwise(F.lit(5)).alias("zoom"))


def route_legs(routes: DataFrame, mode: str = "both") -> DataFrame:
    """V7: map legs per route: `baseline` seller -> customer, `optimized`
    hub -> customer, or `both`."""
    legs = []
    if mode in ("baseline", "both"):
        legs.append(F.struct(F.lit("baseline").alias("leg"), F.col("seller_lat").alias("src_lat"),
                             F.col("seller_lon").alias("src_lon")))
    if mode in ("optimized", "both"):
        legs.append(F.struct(F.lit("optimized").alias("leg"), F.col("hub_lat").alias("src_lat"),
                             F.col("hub_lon").alias("src_lon")))
    if not legs:
        raise ValueError(f"unknown mode {mode!r}")
    return routes.select("order_key", "customer_lat", "customer_lon",
                         F.explode(F.array(*legs)).alias("l")).select(
        "order_key", "l.leg", "l.src_lat", "l.src_lon",
        F.col("customer_lat").alias("dst_lat"), F.col("customer_lon").alias("dst_lon"))
