"""Latest state per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the greatest by ``order`` then ``tiebreak``, NULL lowest.

    Spark turns the rank filter into a group limit that runs before the exchange,
    so each task sends at most one row per key, however hot the key is.
    """
    by = [F.col(name).desc_nulls_last() for name in (*order, *tiebreak)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")
