"""Deterministic `row_number() = 1` deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per `by` key: the first under `order`.

    Every column not named in `by` is appended (ascending, nulls last) as a
    tie-breaker, so the surviving row never depends on partitioning.  The
    `row_number() == 1` filter lets Catalyst insert a partial
    `WindowGroupLimit` before the shuffle: each map task forwards only its own
    best row per key, so a key holding a third of all rows is cut down before
    it reaches a single reducer.
    """
    tie = [F.col(c).asc_nulls_last() for c in df.columns if c not in by]
    w = Window.partitionBy(*by).orderBy(*order, *tie)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


#: Slots of the map of repeated keys (`keep_first_wide`): bitmaps of 32,768 slots, 8 MB at most.
KEY_SLOTS = 1 << 26
_BITMAP = 32_768


def keep_first_wide(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """`keep_first` for rows with long texts: only rows whose key may occur again cross an exchange.

    Hashes of the keys are counted first, and the slots of those that occur more than once are marked in a map of fixed size, which is
    broadcast.  A row whose slot is not marked is the only one of its key and stays where it is.  All others, every row
    of a repeated key and few besides, are decided by `keep_first`.  The frame is read three times, the first time for its keys alone.
    """
    hashed = F.xxhash64(*by)
    slot = F.pmod(F.col("__hash"), F.lit(KEY_SLOTS))
    repeated = (df.select(hashed.alias("__hash")).groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
                .select(F.shiftright(slot, 15).cast("int").alias("__map"), (slot % _BITMAP).alias("__bit"))
                .groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__marks")))
    rows = df.withColumn("__slot", F.pmod(hashed, F.lit(KEY_SLOTS))).join(
        F.broadcast(repeated), F.shiftright("__slot", 15).cast("int") == F.col("__map"), "left")
    place = (F.col("__slot") % _BITMAP).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__marks"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("long")
    marked = F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))
    single, several = rows.where(~marked).select(*df.columns), rows.where(marked).select(*df.columns)
    return single.unionByName(keep_first(several, by, order))
