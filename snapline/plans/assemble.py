"""The two order assemblies, both with the same 24 columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.functions.dates import (
    LOCAL_ZONE, fmt_day, fmt_ts, local_day_start, local_time, now_utc, period_id, read_time, utc_wall, wall_instant,
)
from snapline.functions.keys import key_of
from snapline.operators.joins import anti_not_in, decode, left_by_key, left_window, semi_window, spread_join
from snapline.operators.latest import latest_by
from snapline.operators.pushdown import distinct_ids, restrict_to_keys
from snapline.session import passing_shuffles, scanned_bytes, scratch

# The columns of an order snapshot, in order.
SNAPSHOT_COLUMNS = (
    "report_period_id", "entry_date", "id", "customer_id", "crm_order_id", "status", "created_at",
    "name", "identification_number", "mobile_phone",
    "type_name", "status_name", "sales_channel_name", "order_date_create", "order_close_date",
    "username_created_order", "reject_reason_name", "new_product_offer_id", "new_product_offer_name",
    "cust_order_id", "customer_account_id", "comments", "comment_on_close", "recreated_order",
)
PERSONAL_COLUMNS = ("name", "identification_number", "mobile_phone")
HISTORY_WIDTH = "1 day"

# Bytes of CRM history that a round takes on, and the most rounds: each reads the whole history.
ROUND_BYTES, ROUNDS = 128 << 20, 8

Frames = Mapping[str, DataFrame]


AsOf = Column | DataFrame | str


def _is_instant(df: DataFrame) -> bool:
    """Relational sources deliver instants, files mostly UTC wall times."""
    return isinstance(df.schema["created_at"].dataType, T.TimestampType)


def _localised(df: DataFrame, zone: str) -> DataFrame:
    created = utc_wall("created_at") if _is_instant(df) else F.col("created_at")
    return df.withColumn("created_at", local_time(created, zone))


def _day_start(df: DataFrame, as_of: AsOf | None, zone: str, days: int) -> Column:
    start = local_day_start(now_utc() if as_of is None else as_of, zone, days)
    return wall_instant(start) if _is_instant(df) else start


def driver_history(df: DataFrame, as_of: AsOf | None = None, zone: str = LOCAL_ZONE) -> DataFrame:
    """Orders created before the local day of ``as_of`` (now), ``created_at`` as local time."""
    return _localised(df.where(F.col("created_at") < _day_start(df, as_of, zone, 0)), zone)


def driver_recent(
    df: DataFrame, as_of: AsOf | None = None, zone: str = LOCAL_ZONE, days: int = 1
) -> DataFrame:
    """Orders created on the local day of ``as_of`` (now), up to ``days`` before, or later."""
    return _localised(df.where(F.col("created_at") >= _day_start(df, as_of, zone, days)), zone)


def _customers(lookup: DataFrame, dedupe: bool) -> DataFrame:
    rows = lookup.select(key_of(lookup, "customer_id").alias("__customer"), *PERSONAL_COLUMNS)
    return latest_by(rows, ["__customer"], PERSONAL_COLUMNS) if dedupe else rows


def _staged(name: str, *parts: DataFrame) -> DataFrame:
    """The rows of all parts, written to the scratch folder one part after the other."""
    spark, schema = parts[0].sparkSession, parts[0].schema
    path = scratch(spark, name)
    with passing_shuffles(spark):
        for part in parts:
            part.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _latest_within(crm: DataFrame, windows: DataFrame, width: str, tiebreak: Sequence[str]) -> DataFrame:
    """Per customer its latest CRM order that one of its windows holds.

    A large history is joined in rounds by order id, each a job that leaves the latest of its orders per
    customer, so only a share of the history is in shuffle files at once.
    """
    def latest(rows: DataFrame) -> DataFrame:
        return latest_by(rows, ["__crm_customer"], ["order_date_create"], tiebreak)

    def within(rows: DataFrame) -> DataFrame:
        return latest(semi_window(rows, windows, "__crm_customer", "order_date_create", "__created", width))

    rounds = min(ROUNDS, -(-scanned_bytes(crm) // ROUND_BYTES))
    if rounds < 2:
        return within(crm)
    shown = {name.lower() for name in (*SNAPSHOT_COLUMNS, *tiebreak, "__crm_customer")}
    crm = crm.select(*[F.col(f"`{name}`") for name in crm.columns if name.lower() in shown])
    share = F.pmod(F.xxhash64("cust_order_id"), F.lit(rounds))
    return latest(_staged("latest", *[within(crm.where(share == i)) for i in range(rounds)]))


def _newest_first(df: DataFrame) -> DataFrame:
    """By creation time; the id only spreads equal times over the range partitions."""
    return df.orderBy(F.col("created_at").desc_nulls_last(), F.col("id").desc_nulls_last())


def assemble_history(
    sources: Frames,
    width: str = HISTORY_WIDTH,
    tiebreak: Sequence[str] = ("cust_order_id",),
    dedupe_lookup: bool = False,
) -> DataFrame:
    """Orders not registered in the CRM, enriched from the customer's latest CRM order when
    that was created within ``width`` after them.

    Latest is per customer over all its qualifying CRM orders, not per order. Each CRM
    order is checked against the windows before the ranking, and the ranking leaves one
    row per customer, so only the check exchanges the CRM history.

    The unregistered orders are found once, in a job of its own that writes them to the scratch folder:
    both the windows and the result are made from them, and the not-in reads every order. So are, in
    rounds, the latest CRM orders of a large history.
    """
    orders, ids = sources["customer_orders"], sources["crm_cust_order_ids"]
    ids = ids.select(key_of(ids, "id").alias("id"))
    crm = sources["cust_order_full"]
    crm = crm.withColumn("__crm_customer", key_of(crm, "customer_id")).drop("customer_id")
    orders = orders.withColumn("__order", key_of(orders, "crm_order_id")).withColumn(
        "__customer_key", key_of(orders, "customer_id")
    )

    unregistered = _staged("unregistered", anti_not_in(orders, "__order", ids, "id", restricted=True).drop("__order"))
    windows = unregistered.select(F.col("__customer_key").alias("__crm_customer"), F.col("created_at").alias("__created"))
    latest = _latest_within(crm, windows, width, tiebreak)
    enriched = left_window(
        unregistered, latest, "__customer_key", "__crm_customer", "created_at", "order_date_create", width,
        hash_name="__customer_hash",
    )
    people = _customers(sources["crm_customer"], dedupe_lookup)
    # Same key and hash: this join takes over the partitioning of the one before.
    full = spread_join(enriched, people, [("__customer_key", "__customer")], "left", hash_name="__customer_hash")
    recreated = F.when(F.col("cust_order_id").isNotNull(), 1).otherwise(0)
    return _snapshot(_newest_first(full), recreated)


def recent_details(
    sources: Frames, tiebreak: Sequence[str] = (), restrict: bool = True
) -> DataFrame:
    """The newest state of each of the driver's CRM orders, codes replaced by names.

    Rows are restricted to the driver and reduced to one per order before any decode.
    """
    day = sources["cust_order_day"]
    if restrict:
        day = restrict_to_keys(day, "id", sources["customer_orders"], "crm_order_id")
    day = day.withColumn("update_date", read_time("update_date"))
    newest = latest_by(day, ["id"], ["update_date"], tiebreak)
    named = decode(newest, [
        ("cust_order_type_id", sources["order_types"], "id", "name", "type_name"),
        ("status_id", sources["order_statuses"], "cust_order_status_id", "name", "status_name"),
        ("sales_channel_id", sources["sales_channels"], "id", "name", "sales_channel_name"),
        ("reject_reason_id", sources["reject_reasons"], "po_reject_reason_id", "name", "reject_reason_name"),
        ("new_product_offer_id", sources["product_offers"], "id", "name", "new_product_offer_name"),
    ])
    return named.select(
        key_of(named, "id").alias("cust_order_id"),
        "type_name", "status_name", "sales_channel_name",
        read_time("create_date").alias("order_date_create"),
        read_time("change_status_date").alias("order_close_date"),
        F.col("create_user").alias("username_created_order"),
        "reject_reason_name", "new_product_offer_id", "new_product_offer_name",
        "customer_account_id", "comments", "comment_on_close",
    )


def assemble_recent(
    sources: Frames, tiebreak: Sequence[str] = (), dedupe_lookup: bool = False
) -> DataFrame:
    """All recent orders with the newest state of their own CRM order."""
    orders = sources["customer_orders"]
    # A build has written the details already.
    details = sources["cust_order_day_detail"] if "cust_order_day_detail" in sources else recent_details(sources, tiebreak)
    details = details.withColumn("__detail", F.col("cust_order_id"))
    orders = orders.withColumn("__order", key_of(orders, "crm_order_id")).withColumn(
        "__customer_key", key_of(orders, "customer_id")
    )
    joined = left_by_key(orders, details, "__order", "__detail", split_nulls=True)
    people = _customers(sources["crm_customer"], dedupe_lookup)
    full = left_by_key(joined, people, "__customer_key", "__customer")
    return _snapshot(_newest_first(full), F.lit(0))


def _snapshot(df: DataFrame, recreated: Column) -> DataFrame:
    made = {
        "report_period_id": period_id("created_at"),
        "entry_date": fmt_day("created_at"),
        "created_at": fmt_ts("created_at"),
        "order_date_create": fmt_ts("order_date_create"),
        "order_close_date": fmt_ts("order_close_date"),
        "new_product_offer_id": key_of(df, "new_product_offer_id"),
        "cust_order_id": key_of(df, "cust_order_id"),
        "customer_account_id": key_of(df, "customer_account_id"),
        "recreated_order": recreated,
    }
    return df.select(*[made.get(name, F.col(name)).alias(name) for name in SNAPSHOT_COLUMNS])


def history_sources(sources: Frames) -> dict[str, DataFrame]:
    """The history sources as published beside the snapshot: restricted to the driver."""
    orders = sources["customer_orders"]
    return {
        "customer_orders": orders,
        "cust_order_full": restrict_to_keys(sources["cust_order_full"], "customer_id", orders, "customer_id"),
        "crm_cust_order_ids": distinct_ids(
            restrict_to_keys(sources["crm_cust_order_ids"], "id", orders, "crm_order_id"), "id"
        ),
        "crm_customer": restrict_to_keys(sources["crm_customer"], "customer_id", orders, "customer_id"),
    }


def recent_sources(sources: Frames, tiebreak: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The recent sources as published beside the snapshot."""
    orders = sources["customer_orders"]
    return {
        "customer_orders": orders,
        "cust_order_day_detail": recent_details(sources, tiebreak),
        "crm_customer": restrict_to_keys(sources["crm_customer"], "customer_id", orders, "customer_id"),
    }
