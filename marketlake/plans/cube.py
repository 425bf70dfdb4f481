"""Scenario cube: the what-if answers for any selection without the order lines.

A cell holds the lines of one customer state with the same actual and optimized days: their number, sums of both freights
(two exact longs each), of the days saved, and the number of late ones.  Cells are mergeable: cubes of parts of the lines add
up to the cube of all (`merged`), so a refresh adds the cells of new lines.  A cube has at most states x
days x days cells, whatever the number of lines.

A selection of states and of a longest transit time takes cells, as `scenario.scenario_filter` takes lines, and
`kpis`, `lead_times` and `hub_load` roll them up to what `scenario` works out from the lines.  With `keys` they answer
many selections at once (`selected`: one row a selection and cell).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.expressions import amount_sum, amount_total, count_if, from_units, hub_for_state, in_units
from marketlake.operators.aggregates import histogram
from marketlake.plans.scenario import HISTOGRAM, SLA_DAYS, hub_table, kpi_columns

DIMENSIONS = ["customer_state", "actual_shipping_days", "optimized_shipping_days"]


def scenario_cube(executive: DataFrame) -> DataFrame:
    """The cells of all lines of the what-if projection: one partial aggregate, one small exchange."""
    return executive.groupBy(*DIMENSIONS).agg(
        F.count(F.lit(1)).alias("n_lines"), amount_sum("actual_freight").alias("actual"),
        amount_sum("optimized_freight").alias("optimized"), F.sum("days_saved").cast("long").alias("days"),
        F.count("days_saved").alias("days_n"), count_if(F.col("is_optimized_late") == 0).alias("in_time"))


def merged(cubes: Iterable[DataFrame]) -> DataFrame:
    """The cube of all lines from cubes of parts of them."""
    return reduce(DataFrame.unionByName, cubes).groupBy(*DIMENSIONS).agg(
        F.sum("n_lines").alias("n_lines"), amount_total("actual").alias("actual"), amount_total("optimized").alias("optimized"),
        F.sum("days").alias("days"), F.sum("days_n").alias("days_n"), F.sum("in_time").alias("in_time"))


def selected(cube: DataFrame, states: Sequence[str], max_days: Sequence[int]) -> DataFrame:
    """The cells of every selection of `states` and every longest time: (selection, max_days, cell).

    A selection is a bit mask over `states`; 0 chooses none, which means all lines (also those without a state).
    Cells are first reduced to those that some longest time keeps, then given to the 2^(n-1) selections of their state.
    """
    days = F.explode(F.array(*[F.lit(d) for d in max_days])).alias("max_days")
    cells = cube.select("*", days).where(F.col("optimized_shipping_days") <= F.col("max_days"))
    of = F.lit(None).cast("array<int>")
    for bit, state in enumerate(states):
        masks = F.expr(f"filter(sequence(1, {(1 << len(states)) - 1}), m -> (m & {1 << bit}) != 0)")
        of = F.when(F.col("customer_state") == state, masks).otherwise(of)
    every = F.array(F.lit(0))
    return cells.withColumn("selection", F.explode(F.when(of.isNotNull(), F.concat(every, of)).otherwise(every)))


def kpis(cells: DataFrame, *keys: str) -> DataFrame:
    """V2 from cells: one row of headline numbers (for each value of `keys`)."""
    base, opt = in_units(amount_total("actual")), in_units(amount_total("optimized"))
    agg = cells.groupBy(*keys).agg(
        from_units(base).alias("total_baseline_freight"), from_units(opt).alias("total_optimized_freight"),
        from_units(base - opt).alias("freight_savings"),
        (F.sum("days").cast("double") / F.nullif(F.sum("days_n"), F.lit(0))).alias("avg_days_saved"),
        F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.sum(F.when(F.col("actual_shipping_days") <= SLA_DAYS, F.col("n_lines"))), F.lit(0)).alias("baseline_on_time"),
        F.coalesce(F.sum("in_time"), F.lit(0)).alias("optimized_on_time"))
    return kpi_columns(agg, *keys)


def lead_times(cells: DataFrame, *keys: str, width: float = HISTOGRAM[0], lo: float = HISTOGRAM[1], hi: float = HISTOGRAM[2]) -> DataFrame:
    """V3 from cells."""
    return histogram(cells, {"baseline": F.col("actual_shipping_days"), "optimized": F.col("optimized_shipping_days")},
                     width, lo, hi, weight=F.col("n_lines"), by=keys)


def hub_load(cells: DataFrame, *keys: str) -> DataFrame:
    """V4 from cells: lines handled by each hub (for each value of `keys` that has lines), 0 when idle."""
    hubs = hub_table(cells.sparkSession)
    load = cells.withColumn("hub_name", hub_for_state("customer_state").hub_name)
    if not keys:
        counts = load.groupBy("hub_name").agg(F.sum("n_lines").alias("orders_handled"))
        # at most one row a hub
        return hubs.join(F.broadcast(counts), "hub_name", "left").select(
            "hub_name", "hub_lat", "hub_lon", "capacity", F.coalesce("orders_handled", F.lit(0)).alias("orders_handled"))
    names = [r.hub_name for r in hubs.collect()]       # the literal table of hubs
    counts = load.groupBy(*keys).agg(*[F.sum(F.when(F.col("hub_name") == n, F.col("n_lines")).otherwise(0)).alias(n) for n in names])
    each = counts.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("hub_name"), F.col(f"`{n}`").alias("n")) for n in names])).alias("h"))
    return each.select(*keys, "h.hub_name", F.col("h.n").alias("orders_handled")).join(F.broadcast(hubs), "hub_name").select(
        *keys, "hub_name", "hub_lat", "hub_lon", "capacity", "orders_handled")
