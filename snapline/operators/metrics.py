"""Metric counts, by-name unions, the metric schema and a synthetic series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.functions.keys import truncated_bigint
from snapline.functions.predicates import has_text

METRIC_TEXT = ("platform", "metrics", "entry_date")


def project(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Exactly these columns, each from its expression (renames may swap names)."""
    return df.select(*[expression.alias(name) for name, expression in columns.items()])


def metric_counts(
    events: DataFrame, platform: Column, metric: str, day: Column, where: Column | None = None
) -> DataFrame:
    """Events per platform, metric and day; the filters see the source columns."""
    rows = events.where(has_text(metric))
    if where is not None:
        rows = rows.where(where)
    named = project(rows, {"platform": platform, "metrics": F.col(metric), "entry_date": day})
    return named.groupBy("platform", "metrics", "entry_date").agg(F.count(F.lit(1)).alias("cnt"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns matched by name; a column missing from one frame is NULL there."""
    if not frames:
        raise ValueError("nothing to combine: no sources")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def normalize_metrics(df: DataFrame) -> DataFrame:
    """Text columns as text, ``cnt`` as BIGINT with 0 for anything unreadable."""
    changes = {name: F.col(name).cast("string") for name in METRIC_TEXT if name in df.columns}
    if "cnt" in df.columns:
        changes["cnt"] = F.coalesce(truncated_bigint("cnt"), F.lit(0).cast("bigint"))
    return df.withColumns(changes) if changes else df


def sample_series(catalogue: DataFrame, start_day: str, days: int = 60) -> DataFrame:
    """A daily series per catalogue row: rising trend plus noise, both from arithmetic.

    ``catalogue`` holds platform, metrics and an integer ``seed``; day 0 is the newest
    and ``start_day`` is its date.
    """
    back = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(days - 1).cast("bigint")))
    base = F.lit(50) + F.pmod(F.col("seed") * 7919 + F.col("back") * 104729, F.lit(4951))
    step = F.expr("base div 5")
    trend = F.expr(f"(base * ({3 * days} - back)) div {2 * days}")
    noise = F.pmod(F.col("seed") * 31 + F.col("back") * 17, F.lit(2) * F.col("step") + 1) - F.col("step")
    return (
        catalogue.select("platform", "metrics", F.col("seed").cast("bigint").alias("seed"), back.alias("back"))
        .withColumn("base", base)
        .withColumn("step", step)
        .select(
            "platform",
            "metrics",
            F.date_sub(F.lit(start_day).cast("date"), F.col("back").cast("int")).cast("string").alias("entry_date"),
            (trend + noise).alias("cnt"),
        )
    )
