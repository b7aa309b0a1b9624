"""Restricting a source to what the driver needs, as joins instead of literal lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.functions.keys import key_of
from snapline.operators.joins import spread_join

def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL ids as BIGINT."""
    key = key_of(df, column)
    return df.where(key.isNotNull()).select(key.alias(column)).distinct()


def restrict_to_keys(df: DataFrame, column: str, driver: DataFrame, driver_column: str) -> DataFrame:
    """Rows of ``df`` whose id occurs in the driver; an empty driver leaves no rows.

    Partial aggregation makes the driver's ids distinct before they are exchanged.
    """
    keys = distinct_ids(driver, driver_column).withColumnRenamed(driver_column, "__id")
    keyed = df.withColumn("__key", key_of(df, column))
    return spread_join(keyed, keys, [("__key", "__id")], "left_semi").drop("__key")


def restrict_to_range(df: DataFrame, column: str, driver: DataFrame, driver_column: str) -> DataFrame:
    """Rows of ``df`` between the driver's smallest and largest value.

    The bounds are scalar subqueries: computed once, then pushed into the scan.
    """
    low = driver.agg(F.min(driver_column)).scalar()
    high = driver.agg(F.max(driver_column)).scalar()
    return df.where((F.col(column) >= low) & (F.col(column) <= high))


def key_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: distinct non-NULL count, minimum and maximum of each column."""
    stats = []
    for name in columns:
        stats.append(F.count_distinct(name).alias(f"{name}_ids"))
        stats.append(F.min(name).alias(f"{name}_min"))
        stats.append(F.max(name).alias(f"{name}_max"))
    return df.agg(*stats)
