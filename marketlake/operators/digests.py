"""Comparing tables by bucketed digests: rows travel only where something differs.

Each row falls into a bucket by a hash.  A bucket's digest is its number of rows, two sums and an exclusive or over
independent 64-bit hashes of its rows: order-free and mergeable, so one partial aggregate a table computes them and at most
`BUCKETS` rows a table are exchanged.  Tables whose digests agree hold the same rows (but for hash collisions in all
parts at once).  Rows are hashed and compared one by one only in buckets whose digests differ.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
_LOW = (1 << 32) - 1


def _hash(columns: list[str], seed: int) -> Column:
    """64-bit hash of whole rows; null and empty differ."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(_hash(columns, 1), F.lit(buckets)).cast("int")


def digest(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, low, high, mix): the digest of each bucket that has rows."""
    rows = df.select(_hash(columns, 1).alias("h"), _hash(columns, 2).alias("g"))
    return rows.groupBy(F.pmod("h", F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("g").bitwiseAND(F.lit(_LOW))).alias("low"),
        F.sum(F.shiftrightunsigned("g", 32)).alias("high"), F.bit_xor("h").alias("mix"))


Pairs = Mapping[str, tuple[DataFrame, DataFrame, list[str]]]


def _sides(pairs: Pairs, buckets: int) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        digest(side, columns, buckets).select(F.lit(name).alias("name"), F.lit(sign).alias("sign"), "*")
        for name, (left, right, columns) in pairs.items() for side, sign in ((left, 1), (right, -1))])


def differing_buckets(pairs: Pairs, buckets: int = BUCKETS) -> DataFrame:
    """(name, bucket, rows, differs) of every bucket: rows of the first table, and whether the digests differ."""
    own = F.col("sign") > 0

    def both(c: str) -> Column:
        return F.max(F.when(own, F.col(c))).eqNullSafe(F.max(F.when(~own, F.col(c))))

    return _sides(pairs, buckets).groupBy("name", "bucket").agg(
        F.coalesce(F.max(F.when(own, F.col("n"))), F.lit(0)).alias("rows"),
        (~(both("n") & both("low") & both("high") & both("mix"))).alias("differs"))


def compare_tables(pairs: Pairs, buckets: int = BUCKETS) -> DataFrame:
    """(name, rows, rows_missing, rows_extra) of each pair (table, what it should hold, columns).

    rows counts the table; missing rows are only in what it should hold, extra ones only in the table, copies counted.  Digests are taken
    when this is called: a bounded number of rows reaches the driver.
    """
    first = next(iter(pairs.values()))[0].sparkSession
    found = differing_buckets(pairs, buckets).collect()      # at most `buckets` rows a pair
    totals = {name: 0 for name in pairs}
    differing: dict[str, list[int]] = {}
    for r in found:
        totals[r["name"]] += r["rows"]
        if r["differs"]:
            differing.setdefault(r["name"], []).append(r["bucket"])
    rows = first.createDataFrame(list(totals.items()), "name string, rows long")
    if not differing:
        return rows.select("name", "rows", F.lit(0).cast("long").alias("rows_missing"), F.lit(0).cast("long").alias("rows_extra"))
    over = reduce(DataFrame.unionByName, [
        side.where(_bucket(columns, buckets).isin(differing[name])).select(
            F.lit(name).alias("name"), _hash(columns, 1).alias("h"), _hash(columns, 2).alias("g"), F.lit(sign).alias("sign"))
        for name, (left, right, columns) in pairs.items() if name in differing for side, sign in ((left, 1), (right, -1))])
    counted = over.groupBy("name", "h", "g").agg(F.sum("sign").cast("long").alias("over")).groupBy("name").agg(
        F.sum(F.greatest(-F.col("over"), F.lit(0))).alias("rows_missing"), F.sum(F.greatest("over", F.lit(0))).alias("rows_extra"))
    return rows.join(counted, "name", "left").select(
        "name", "rows", F.coalesce("rows_missing", F.lit(0)).alias("rows_missing"), F.coalesce("rows_extra", F.lit(0)).alias("rows_extra"))
