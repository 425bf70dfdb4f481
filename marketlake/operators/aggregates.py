"""Aggregation operators: distinct-then-average, fixed-width histogram, top-k."""

from __future__ import annotations

import math

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.expressions import exact_avg


def distinct_then_avg(df: DataFrame, keys: Sequence[str], grain: Sequence[str],
                      value: str, scale: int, alias: str) -> DataFrame:
    """Average `value` per `keys` after collapsing rows to distinct (grain, value).

    Stops fan-out (many line items per order) from weighting a per-order score.
    Both steps are hash aggregates with map-side partial aggregation.
    """
    cols = list(dict.fromkeys([*keys, *grain, value]))
    return (
        df.select(*cols).distinct()
        .groupBy(*keys)
        .agg(exact_avg(value, scale).alias(alias))
    )


def histogram(df: DataFrame, series: Mapping[str, Column], width: float,
              lo: float, hi: float, weight: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins [lo + i*width, lo + (i+1)*width).

    Edges step from `lo` by `width` until they reach or pass `hi`.  Values below
    `lo` are counted as bin -1 (no start), values from the last edge on as the bin after
    the last (no end), so that the counts add up; nulls and NaN are in no bin.  All series are
    stacked in one pass (explode of a struct array, no union
    re-scan) and counted with a partial aggregate; only non-empty bins appear.
    With `weight` a row counts that many times; `by` counts each group of those columns on its own.
    Output: the columns `by`, series, bin_index, bin_start, bin_end, n.
    """
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("series"), col.cast("double").alias("x"))
        for name, col in series.items()
    ])).alias("s")
    bins = math.ceil((hi - lo) / width)
    x = F.col("s.x")
    idx = (F.when(x < F.lit(lo), F.lit(-1)).when(x >= F.lit(lo + bins * width), F.lit(bins))
           .otherwise(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int")))
    return (
        df.select(*by, (F.lit(1).cast("long") if weight is None else weight).alias("__weight"), stacked)
        .filter(x.isNotNull() & ~F.isnan(x))
        .groupBy(*by, F.col("s.series").alias("series"), idx.alias("bin_index"))
        .agg(F.sum("__weight").alias("n"))
        .select(
            *by, "series", "bin_index",
            F.when(F.col("bin_index") >= 0, F.lit(lo) + F.col("bin_index") * F.lit(width)).alias("bin_start"),
            F.when(F.col("bin_index") < bins, F.lit(lo) + (F.col("bin_index") + 1) * F.lit(width)).alias("bin_end"),
            "n",
        )
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows under a total order (each input partition sends its own k best)."""
    return df.orderBy(*order).limit(k)
