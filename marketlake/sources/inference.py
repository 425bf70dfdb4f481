"""Column types inferred from whole files, keeping what text types would lose.

Each value is given the set of types that hold it without loss, as a mask of bits; the types of a column are the intersection of its values'
sets, and its type the narrowest one left.  Intersection is `bit_and`: it is order-free and mergeable, so one partial
aggregate over all values infers all columns of all sources and one row a column and task is exchanged.  Rules for a value:

* `boolean`: true or false, in any case;
* `int`, `long`, `double`: decimal numbers within range.  A number with a leading zero (`01037`) is a string, and so
  is an integer beyond a long, whose digits a double would lose;
* `timestamp`: a date, or a date and a time, as in the landing files;
* `string`: everything.

Nulls fit every type; a column without values is `void`.  Values with blanks around them, and the names of infinities, are strings.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Narrowest first; the position is the bit.
TYPES = ("boolean", "int", "long", "double", "timestamp", "string")
_CASTS = {"long": "bigint", "timestamp": "timestamp_ntz", "void": "string"}

# How numbers and times are written.
INTEGER = r"^-?(0|[1-9][0-9]*)\z"
NUMBER = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][-+]?[0-9]+)?\z"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?\z"
LEADING_ZERO = r"^-?0[0-9]+\z"


def _bits(*names: str) -> Column:
    return F.lit(sum(1 << TYPES.index(n) for n in (*names, "string")))


def fitting_types(value: Column) -> Column:
    """The mask of the types that hold a text without loss; null for null."""
    finite = F.abs(value.try_cast("double")) < F.lit(float("inf"))
    whole = value.try_cast("bigint")     # a failed cast is an exception, so only of what is written as an integer
    integer = (F.when(whole.between(-(1 << 31), (1 << 31) - 1), _bits("int", "long", "double"))
               .when(whole.isNotNull(), _bits("long", "double")).otherwise(_bits()))
    # The first byte tells texts from numbers and times, so that long texts meet no pattern.
    return (F.when(value.isNull(), F.lit(None).cast("int"))
            .when((value < "-") | (value >= ":"),
                  F.when((F.octet_length(value) <= 5) & F.lower(value).isin("true", "false"), _bits("boolean")).otherwise(_bits()))
            .when((F.substring(value, 5, 1) == "-") & value.rlike(TIMESTAMP),
                  F.when(value.try_cast("timestamp_ntz").isNotNull(), _bits("timestamp")).otherwise(_bits()))
            .when(value.rlike(INTEGER), integer)
            .when(value.rlike(NUMBER), F.when(finite, _bits("double")).otherwise(_bits()))
            .otherwise(_bits()))


def _narrowest(mask: Column) -> Column:
    return reduce(lambda rest, n: F.when(mask.bitwiseAND(F.lit(1 << TYPES.index(n))) != 0, n).otherwise(rest),
                  TYPES[::-1], F.lit("void"))


def infer_types(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(source, position, column_name, inferred_type, filled, leading_zeros) of every column of all-string frames, over all rows.

    filled: values that are not null; leading_zeros: integers among them that start with a zero.  An empty frame has `void` columns.
    """
    # One value a row, so that the rules are compiled once and not once a column.
    values = reduce(DataFrame.unionByName, [
        df.select(F.lit(source).alias("source"), F.posexplode(F.array(*[F.col(c) for c in df.columns])).alias("position", "value"))
        for source, df in frames.items()])
    value = F.col("value")
    found = values.groupBy("source", "position").agg(
        F.bit_and(fitting_types(value)).alias("mask"), F.count(value).alias("filled"),
        F.count_if((value >= "-") & (value < "1") & value.rlike(LEADING_ZERO)).alias("leading_zeros"))
    columns = values.sparkSession.createDataFrame(
        [(source, i, c) for source, df in frames.items() for i, c in enumerate(df.columns)], "source string, position int, column_name string")
    none = F.lit(0).cast("long")
    rows = (columns.join(found, ["source", "position"], "left")
            .withColumns({c: F.coalesce(c, none) for c in ("filled", "leading_zeros")}))
    return rows.select("source", "position", "column_name", _narrowest(F.coalesce("mask", F.lit(0))).alias("inferred_type"),
                       "filled", "leading_zeros")


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """An all-string frame with columns cast to inferred types (columns without one stay)."""
    return df.select(*[F.col(c).cast(_CASTS.get(types[c], types[c])).alias(c) if c in types else F.col(c) for c in df.columns])


def read_inferred(df: DataFrame) -> DataFrame:
    """An all-string frame with the types inferred from all its rows; the inference runs now and gives one row a column."""
    found = infer_types({"": df}).collect()
    return typed(df, {r.column_name: r.inferred_type for r in found})
