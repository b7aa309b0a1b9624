"""Distinct counts that merge: a sketch per day and column, stored once, united on demand.

An exact distinct count needs every value of the whole period in one place each time it is asked.
A HyperLogLog sketch of a day is some kilobytes, days are united without their rows, and a new day
adds its own sketches beside the others. Exact counts stay the default; these are for asking any
period of a large history at once. NULLs and rows are counted exactly beside them.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The logarithm of a sketch's registers: its error falls with their square root.
REGISTERS = 12


def error_bound(registers: int = REGISTERS, deviations: float = 3.0) -> float:
    """The relative error that a united estimate keeps below in all but 3 of 1,000 cases."""
    return deviations * 1.04 / sqrt(1 << registers)


def _sketchable(df: DataFrame, name: str) -> Column:
    """A form that is distinct exactly when the values are."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    return column if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else column.cast("string")


def day_sketches(df: DataFrame, day: str, columns: Sequence[str], registers: int = REGISTERS) -> DataFrame:
    """``day, column_name, row_count, nulls, sketch``: one pass, partial sketches before the exchange."""
    values = [
        F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(f"`{name}`").isNull()).alias("nulls"),
            F.hll_sketch_agg(_sketchable(df, name), registers).alias("sketch"),
        ).alias(f"c{i}")
        for i, name in enumerate(columns)
    ]
    wide = df.groupBy(F.col(f"`{day}`").alias("day")).agg(*values)
    return wide.select("day", F.inline(F.array(*[f"c{i}" for i in range(len(values))])))


def _counted(sketch: Column) -> Column:
    return F.hll_sketch_estimate(sketch).alias("distinct_values")


def distinct_by_day(sketches: DataFrame) -> DataFrame:
    """``day, column_name, row_count, nulls, distinct_values`` from the stored sketches."""
    return sketches.select("day", "column_name", "row_count", "nulls", _counted(F.col("sketch")))


def distinct_between(sketches: DataFrame, first=None, last=None) -> DataFrame:
    """``column_name, row_count, nulls, distinct_values`` of a period (bounds included), no row read."""
    if first is not None:
        sketches = sketches.where(F.col("day") >= F.lit(first))
    if last is not None:
        sketches = sketches.where(F.col("day") <= F.lit(last))
    return sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("nulls").alias("nulls"), _counted(F.hll_union_agg("sketch"))
    )
