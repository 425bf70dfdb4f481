"""Exact distinct counts from mergeable bitmaps.

`numbered` gives every key a number, dense from 1.  `bitmap_table` keeps, for each group, which numbers occur in it: one fixed
bitmap of 32,768 numbers a row (group, bucket).  Bitmaps of groups are joined by a bitwise or, so the distinct count of
any union of groups (`distinct_counts`) comes from the stored bitmaps alone: no expansion of the facts for each count, no shuffle of
(group, key) pairs, and no error.  A table has at most groups x (keys / 32,768 + 1) rows of 4 KB: made for groups that hold a good
part of the keys (states, months), not for one group a seller.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import checkpoint_dir


def numbered(keys: DataFrame, key: str) -> DataFrame:
    """(key, number): a number from 1 for each distinct key that is not null, in the keys' order, without gaps.

    Keys are range partitioned and numbered inside their partition, behind the keys of the partitions before: one
    count a partition is added up over the cluster.  The partitions are checkpointed, so numbers never change.
    """
    spark = keys.sparkSession
    checkpoint_dir(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(tasks, key).withColumn(
        "part", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row a partition
    starts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(key))
    return dealt.withColumn("place", place).join(starts, "part").select(key, (F.col("start") + F.col("place")).alias("number"))


def bitmap_table(rows: DataFrame, groups: Sequence[str], key: str, numbers: DataFrame) -> DataFrame:
    """(groups, bucket, bitmap) of the keys that occur in each group; null keys do not count."""
    found = rows.select(*groups, key).join(numbers, key)
    return found.groupBy(*groups, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], alias: str = "n") -> DataFrame:
    """The number of distinct keys in the union of the groups that share `by` (none: of all)."""
    joined = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counted = joined.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(alias))
    return counted.select(*by, F.coalesce(alias, F.lit(0)).alias(alias))


def rollups(bitmaps: DataFrame, sets: Sequence[Sequence[str]], columns: Sequence[str], alias: str = "n") -> DataFrame:
    """`distinct_counts` for several grouping sets; a column that a set leaves out is null, and `level` is the set's number."""
    parts = []
    for level, by in enumerate(sets):
        counts = distinct_counts(bitmaps, by, alias)
        parts.append(counts.select(F.lit(level).alias("level"), *[
            F.col(c) if c in by else F.lit(None).cast(bitmaps.schema[c].dataType).alias(c) for c in columns], alias))
    return reduce(DataFrame.unionByName, parts)
