"""Tables compared by bucketed digests."""
from pyspark.sql import functions as F

from marketlake.operators.digests import compare_tables, differing_buckets


def _table(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def test_equal_tables_need_no_rows(spark):
    rows = [(str(i % 50), str(i % 7)) for i in range(1000)] + [(None, ""), ("", None)]
    left, right = _table(spark, rows), _table(spark, rows[::-1]).repartition(3)
    out = compare_tables({"t": (left, right, ["k", "v"])})
    assert [tuple(r) for r in out.collect()] == [("t", 1002, 0, 0)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()     # counted by the digests alone
    plan = differing_buckets({"t": (left, right, ["k", "v"])})._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_xor" in plan                                                   # reduced before the exchange


def test_planted_differences_are_counted(spark):
    rows = [(str(i), str(i % 7)) for i in range(2000)]
    left = _table(spark, rows[:-3] + [("new", "x"), ("5", "5"), ("5", "5"), ("a", None)])
    right = _table(spark, rows + [("a", "")])
    out = {r["name"]: tuple(r)[1:] for r in compare_tables({
        "t": (left, right, ["k", "v"]), "same": (left, left, ["k", "v"]), "none": (left.limit(0), left.limit(0), ["k"]),
        "gone": (left.limit(0), _table(spark, rows[:9]), ["k", "v"])}).collect()}
    assert out == {"t": (2001, 4, 4), "same": (2001, 0, 0), "none": (0, 0, 0), "gone": (0, 9, 0)}


def test_swapped_values_and_copies_differ(spark):
    a = _table(spark, [("x", "y"), ("p", "q"), ("p", "q")])
    b = _table(spark, [("y", "x"), ("p", "q"), ("x", "y")])
    assert tuple(compare_tables({"t": (a, b, ["k", "v"])}).first())[1:] == (3, 1, 1)
    wide = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit("c").alias("v"))
    assert tuple(compare_tables({"t": (wide, wide.where("k != '77'"), ["k", "v"])}, buckets=4).first())[1:] == (5000, 0, 1)
