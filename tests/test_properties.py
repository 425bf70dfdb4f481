"""Randomized checks of the numeric helpers and operators against brute force.

Each hypothesis example is one multi-group dataset, evaluated in one Spark
job and recomputed in plain Python with exact Decimal arithmetic.
"""
import math
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.functions.expressions import count_if, exact_avg, money_sum, pct
from marketlake.operators import histogram, keep_first

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

cents = st.integers(min_value=-10_000_00, max_value=10_000_00)
rows_money = st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), cents), st.integers(-5, 60)),
                      min_size=1, max_size=300)


def _half_up(x: Decimal, n: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))


@SETTINGS
@given(rows_money)
def test_money_sum_avg_and_pct_are_exact(spark, rows):
    df = spark.createDataFrame([(g, None if c is None else c / 100, d) for g, c, d in rows],
                               "g int, amount double, days int")
    got = {r.g: r for r in df.groupBy("g").agg(
        money_sum("amount").alias("total"),
        exact_avg("amount", 2, is_money=True).alias("avg_amount"),
        exact_avg("days", 1).alias("avg_days"),
        pct(count_if(F.col("days") > 20), F.count(F.lit(1)), 2).alias("late_pct")).collect()}
    groups = defaultdict(list)
    for g, c, d in rows:
        groups[g].append((c, d))
    assert set(got) == set(groups)
    for g, vals in groups.items():
        amounts = [Decimal(c) / 100 for c, _ in vals if c is not None]
        r = got[g]
        assert r.total == (float(sum(amounts)) if amounts else None)
        assert r.avg_amount == (_half_up(sum(amounts) / len(amounts), 2) if amounts else None)
        assert r.avg_days == _half_up(Decimal(sum(d for _, d in vals)) / len(vals), 1)
        assert r.late_pct == _half_up(Decimal(sum(d > 20 for _, d in vals) * 100) / len(vals), 2)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10, 60), st.integers(-10, 60)), min_size=1, max_size=300))
def test_histogram_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    got = {(r.series, r.bin_index): r.n for r in
           histogram(df, {"a": F.col("a"), "b": F.col("b")}, 1.5, 0.0, 40.0).collect()}
    want = defaultdict(int)
    bins = math.ceil(40.0 / 1.5)
    for a, b in rows:
        for name, x in (("a", a), ("b", b)):
            want[(name, max(-1, min(bins, math.floor(x / 1.5))))] += 1
    assert got == dict(want)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 20), st.one_of(st.none(), st.integers(0, 5)),
                          st.sampled_from(["a", "b", "c", None])), min_size=1, max_size=200))
def test_keep_first_is_the_sorted_minimum(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v string")
    got = {r.k: (r.t, r.v) for r in keep_first(df, ["k"], [F.col("t").desc_nulls_last()]).collect()}

    def order(row):  # t desc nulls last, then v asc nulls last
        _, t, v = row
        return (t is None, -(t or 0), v is None, v or "")
    want = {}
    for row in sorted(rows, key=order):
        want.setdefault(row[0], (row[1], row[2]))
    assert got == want
