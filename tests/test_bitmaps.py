"""Exact distinct counts from bitmaps."""
from marketlake.operators import bitmaps
from marketlake.plans.registry import models

from conftest import SF_SMOKE


def test_numbers_are_dense_ordered_and_stable(spark):
    keys = spark.range(1000).selectExpr("if(id % 10 = 0, null, concat('k', id % 300)) AS k")
    numbers = bitmaps.numbered(keys, "k")
    found = sorted((r.number, r.k) for r in numbers.collect())
    names = sorted({f"k{i % 300}" for i in range(1000) if i % 10})
    assert found == list(enumerate(names, 1)) == sorted((r.number, r.k) for r in numbers.collect())
    assert bitmaps.numbered(keys.limit(0), "k").count() == 0


def test_counts_of_any_union_over_several_buckets(spark):
    rows = spark.range(200_000).selectExpr("id * 7919 % 100003 AS k", "id % 5 AS g", "id % 3 AS h")
    table = bitmaps.bitmap_table(rows, ["g", "h"], "k", bitmaps.numbered(rows, "k")).persist()
    assert table.select("bucket").distinct().count() == 4
    for by in (["g", "h"], ["h"], []):
        want = sorted(map(str, rows.selectExpr(*by, "k").distinct().groupBy(*by).count().selectExpr(*by, "count AS n").collect()))
        assert sorted(map(str, bitmaps.distinct_counts(table, by).collect())) == want
    some = table.where("g in (1, 4)")
    assert bitmaps.distinct_counts(some, []).first().n == rows.where("g in (1, 4)").select("k").distinct().count()
    table.unpersist()
    none = bitmaps.bitmap_table(rows.limit(0), ["g"], "k", bitmaps.numbered(rows.limit(0), "k"))
    assert bitmaps.distinct_counts(none, []).first().n == 0


def test_corridors_equal_the_mart(spark):
    from marketlake.plans.registry import corridor_order_rollup
    got = {(r.origin_state, r.destination_state): r.total_orders for r in corridor_order_rollup(spark, SF_SMOKE).where("level = 0").collect()}
    mart = models(spark, SF_SMOKE)["gold_regional_logistics"].collect()
    assert got == {(r.origin_state, r.destination_state): r.total_orders_shipped for r in mart}
