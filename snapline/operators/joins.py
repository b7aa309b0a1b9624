"""Joins across stores: lookups, not-in, time windows, decodes.

Broadcasting is left to Spark, which does it only for a side whose measured size
is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.functions.keys import key_of


def spread_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str,
    residual: Column | None = None,
    hash_name: str | None = None,
) -> DataFrame:
    """Equi join on ``pairs`` that stays splittable when one key is hot.

    A right side that was aggregated or ranked by the same key would be joined in
    place, and the adaptive skew-join rule cannot split a partition whose other side
    is not a fresh exchange. Joining on the key *and* its hash gives both sides an
    exchange of their own; the right side is the reduced one, so that is cheap.
    Right key columns are dropped.

    ``hash_name`` keeps the left hash under that name; a second join on the same key
    that names it again reuses the exchange of the first.
    """
    for lname, rname in pairs:
        if left.schema[lname].dataType != right.schema[rname].dataType:
            raise TypeError(f"join keys differ in type: {lname}, {rname}")
    kept = hash_name or "__left_hash"
    renamed = {rname: f"__right_{i}" for i, (_, rname) in enumerate(pairs)}
    right = right.withColumnsRenamed(renamed)
    right = right.withColumn("__right_hash", F.xxhash64(*renamed.values()))
    if kept not in left.columns:
        left = left.withColumn(kept, F.xxhash64(*[lname for lname, _ in pairs]))
    tests = [F.col(lname) == F.col(renamed[rname]) for lname, rname in pairs]
    tests.append(F.col(kept) == F.col("__right_hash"))
    if residual is not None:
        tests.append(residual)
    joined = left.join(right, reduce(and_, tests), how).drop("__right_hash", *renamed.values())
    return joined if hash_name else joined.drop(kept)


def left_by_key(
    left: DataFrame, right: DataFrame, lkey: str, rkey: str, split_nulls: bool = False
) -> DataFrame:
    """Left join on two BIGINT keys; duplicates on the right fan out.

    ``rkey`` is dropped. With ``split_nulls`` the rows without a key, often the
    largest group, skip the exchange: they are known to find nothing.
    """
    renamed = right.withColumnRenamed(rkey, "__rkey")
    on = F.col(lkey) == F.col("__rkey")
    if not split_nulls:
        return left.join(renamed, on, "left").drop("__rkey")
    found = left.where(F.col(lkey).isNotNull()).join(renamed, on, "left").drop("__rkey")
    fields = [f for f in right.schema.fields if f.name != rkey]
    bare = left.where(F.col(lkey).isNull()).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    )
    return found.unionByName(bare)


def anti_not_in(
    df: DataFrame, key: str, ids: DataFrame, id_col: str, restricted: bool = False
) -> DataFrame:
    """SQL ``key NOT IN (ids)`` without its broadcast of the whole id set.

    A NULL key survives only when the id set is empty. With ``restricted`` the id set
    counts as restricted to the keys of ``df``, so it is empty when no key is found;
    the test shares the exchange of the ids with the join.
    """
    keyed = df.where(F.col(key).isNotNull())
    present = ids.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    kept = spread_join(keyed, present, [(key, id_col)], "left_anti")
    found = spread_join(keyed, present, [(key, id_col)], "left_semi") if restricted else present
    unknown = df.where(F.col(key).isNull() & ~found.exists())
    return kept.unionByName(unknown)


def semi_window(
    df: DataFrame, anchor: DataFrame, key: str, ts: str, start: str, width: str
) -> DataFrame:
    """Rows of ``df`` for which some ``anchor`` row of the same key has
    ``start <= ts <= start + width``.

    Time is cut into slots of ``width``. An anchor that covers ``ts`` lies in the slot
    of ``ts`` (then it only has to be early enough) or in the one before (then it only
    has to be late enough). So per key and slot the earliest and the latest anchor
    decide, and the anchors shrink to one row per key and slot before they are
    exchanged: exact, linear, and no key brings its pairs together.
    """
    span = F.expr(f"interval {width}")
    slot = F.window(start, width).start
    nothing = F.lit(None).cast("timestamp_ntz")
    edges = (
        anchor.where(F.col(key).isNotNull())
        .select(F.col(key).alias("__key"), F.col(start).alias("__start"), slot.alias("__slot"))
        .select(
            "__key",
            F.inline(
                F.array(
                    F.struct(F.col("__slot").alias("__at"), F.col("__start").alias("__same"), nothing.alias("__before")),
                    F.struct((F.col("__slot") + span).alias("__at"), nothing.alias("__same"), F.col("__start").alias("__before")),
                )
            ),
        )
        .groupBy("__key", "__at")
        .agg(F.min("__same").alias("__same"), F.max("__before").alias("__before"))
    )
    probe = df.withColumn("__slot", F.window(ts, width).start)
    covered = (F.col(ts) >= F.col("__same")) | (F.col(ts) <= F.col("__before") + span)
    return spread_join(probe, edges, [(key, "__key"), ("__slot", "__at")], "left_semi", covered).drop("__slot")


def left_window(
    anchor: DataFrame,
    df: DataFrame,
    key: str,
    df_key: str,
    start: str,
    ts: str,
    width: str,
    hash_name: str | None = None,
) -> DataFrame:
    """Left join ``anchor`` with ``df`` on the key where ``start <= ts <= start + width``.

    ``df`` holds one row per key (the output of ``latest_by``).
    """
    residual = (F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(start) + F.expr(f"interval {width}"))
    return spread_join(anchor, df, [(key, df_key)], "left", residual, hash_name)


def decode(df: DataFrame, steps: Sequence[tuple[str, DataFrame, str, str, str]]) -> DataFrame:
    """Chain of left joins id -> name: ``(foreign key, dimension, its key, name column, alias)``."""
    for foreign, dimension, key, name, alias in steps:
        names = dimension.select(key_of(dimension, key).alias("__dim"), F.col(name).alias(alias))
        df = df.withColumn("__fk", key_of(df, foreign))
        df = df.join(names, F.col("__fk") == F.col("__dim"), "left").drop("__fk", "__dim")
    return df
