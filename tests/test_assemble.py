import pytest
from pyspark.sql import functions as F

from snapline.functions.dates import read_time, wall_instant
from snapline.plans.assemble import (
    SNAPSHOT_COLUMNS, assemble_history, assemble_recent, driver_history, driver_recent, history_sources, recent_sources,
)

ORDERS = [
    (1, 100, 9001, "new", "2024-05-01 10:00:00"),
    (2, 100, 9002, "new", "2024-05-03 10:00:00"),
    (3, 200, 9003, "new", "2024-05-01 10:00:00"),
    (4, 300, None, "new", "2024-05-01 10:00:00"),
    (5, 400, 9005, "error", "2024-05-01 10:00:00"),
    (6, 100, 9006, "new", "2024-05-03 20:00:00"),
    (7, 500, 9007, "new", "2024-05-01 10:00:00"),
]
CRM = [
    (100.0, "2024-05-01 12:00:00", 1), (100.0, "2024-05-04 09:00:00", 2), (200.0, "2024-05-02 10:00:00", 3),
    (400.0, "2024-05-02 10:00:01", 4), (500.0, "2024-05-01 09:59:59", 5), (300.0, "2024-05-01 11:00:00", 6),
]


def _orders(spark):
    df = spark.createDataFrame(ORDERS, "id bigint, customer_id bigint, crm_order_id bigint, status string, at string")
    return df.withColumn("created_at", read_time("at")).drop("at")


def _history(spark, ids, customers=((100.0, "Ann", "i1", "m1"),)):
    crm = spark.createDataFrame(CRM, "customer_id double, at string, n bigint").select(
        "customer_id",
        read_time("at").alias("order_date_create"),
        F.lit(None).cast("timestamp_ntz").alias("order_close_date"),
        *[F.lit("x").alias(c) for c in ("type_name", "status_name", "sales_channel_name", "username_created_order",
                                        "reject_reason_name", "new_product_offer_name", "comments", "comment_on_close")],
        F.lit(5.0).alias("new_product_offer_id"),
        F.col("n").cast("double").alias("cust_order_id"),
        F.lit("6.5").alias("customer_account_id"),
    )
    return {
        "customer_orders": _orders(spark),
        "cust_order_full": crm,
        "crm_cust_order_ids": spark.createDataFrame([(float(i),) for i in ids], "id double"),
        "crm_customer": spark.createDataFrame(
            list(customers), "customer_id double, name string, identification_number string, mobile_phone string"
        ),
    }


REGISTERED = [(1, None, 0), (2, 2, 1), (3, 3, 1), (6, 2, 1), (7, None, 0)]


@pytest.mark.parametrize("ids, expected", [
    ([9005], REGISTERED),
    ([9005, 4711], REGISTERED),
    ([], sorted(REGISTERED + [(4, 6, 1), (5, None, 0)])),
    ([4711], sorted(REGISTERED + [(4, 6, 1), (5, None, 0)])),
])
def test_history(spark, ids, expected):
    df = assemble_history(_history(spark, ids))
    assert tuple(df.columns) == SNAPSHOT_COLUMNS
    assert sorted((r.id, r.cust_order_id, r.recreated_order) for r in df.collect()) == expected


def test_history_columns_and_order(spark):
    result = assemble_history(_history(spark, [9005])).collect()
    assert [r.created_at for r in result] == sorted((r.created_at for r in result), reverse=True)
    second = next(r for r in result if r.id == 2).asDict()
    assert second["report_period_id"] == 202405 and second["entry_date"] == "2024-05-03"
    assert second["order_date_create"] == "2024-05-04 09:00:00" and second["order_close_date"] is None
    assert second["new_product_offer_id"] == 5 and second["customer_account_id"] == 7 and second["name"] == "Ann"


def test_duplicate_lookup_rows_fan_out_unless_told_otherwise(spark):
    twice = [(200.0, "Bo", "i", "m"), (200.0, "Cy", "i", "m")]
    df = assemble_history(_history(spark, [9005], twice))
    assert sorted(r.name for r in df.where("id = 3").collect()) == ["Bo", "Cy"]
    one = assemble_history(_history(spark, [9005], twice), dedupe_lookup=True)
    assert [r.name for r in one.where("id = 3").collect()] == ["Cy"]


def test_published_sources_are_restricted_to_the_driver(spark):
    frames = history_sources(_history(spark, [9005, 9005, 1], [(100.0, "a", "b", "c"), (999.0, "a", "b", "c")]))
    assert {name: df.count() for name, df in frames.items()} == {
        "customer_orders": 7, "cust_order_full": 6, "crm_cust_order_ids": 1, "crm_customer": 1,
    }


def _recent(spark):
    day = spark.createDataFrame(
        [
            (9001.0, 1.0, 1.0, None, "2024-05-01 11:00:00", "old"),
            (9001.0, 2.0, 1.0, 3.0, "2024-05-01 12:00:00", "new"),
            (9002.0, 1.0, 9.0, None, None, "undated"),
            (9002.0, 1.0, 9.0, None, "not a date", "undated too"),
            (1.0, 1.0, 1.0, 1.0, "2024-05-01 12:00:00", "another driver's"),
        ],
        "id double, status_id double, cust_order_type_id double, reject_reason_id double, update_date string, comments string",
    ).select(
        "*",
        F.lit(1.0).alias("sales_channel_id"), F.lit(2.0).alias("new_product_offer_id"), F.lit(3.0).alias("customer_account_id"),
        F.col("update_date").alias("create_date"), F.col("update_date").alias("change_status_date"),
        F.lit("u1").alias("create_user"), F.lit("").alias("comment_on_close"),
    )
    names = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id int, name string")
    return {
        "customer_orders": _orders(spark),
        "cust_order_day": day,
        "crm_customer": _history(spark, [])["crm_customer"],
        "order_types": names,
        "order_statuses": names.withColumnRenamed("id", "cust_order_status_id"),
        "sales_channels": names,
        "reject_reasons": names.withColumnRenamed("id", "po_reject_reason_id"),
        "product_offers": names,
    }


def test_recent(spark):
    result = {r.id: r for r in assemble_recent(_recent(spark), ["comments"]).collect()}
    assert tuple(result[1].asDict()) == SNAPSHOT_COLUMNS
    assert len(result) == len(ORDERS) and {r.recreated_order for r in result.values()} == {0}
    first = result[1]
    assert (first.status_name, first.type_name, first.reject_reason_name) == ("two", "one", "three")
    assert (first.comments, first.cust_order_id, first.order_close_date) == ("new", 9001, "2024-05-01 12:00:00")
    assert (result[2].comments, result[2].type_name) == ("undated too", None)
    assert result[4].cust_order_id is None and result[3].cust_order_id is None


def test_published_recent_sources(spark):
    frames = recent_sources(_recent(spark), ["comments"])
    assert {name: df.count() for name, df in frames.items()} == {
        "customer_orders": 7, "cust_order_day_detail": 2, "crm_customer": 1,
    }


def test_drivers_share_one_day(spark):
    """The recent driver reaches back to yesterday, which history already holds."""
    orders = _orders(spark)
    history = {r.id for r in driver_history(orders, "2024-05-03 08:00:00").collect()}
    recent = {r.id for r in driver_recent(orders, "2024-05-03 08:00:00").collect()}
    assert history == {1, 3, 4, 5, 7} and recent == {2, 6}
    wider = {r.id for r in driver_recent(orders, "2024-05-02 08:00:00").collect()}
    assert wider == {1, 2, 3, 4, 5, 6, 7}


def test_drivers_take_instants_in_any_session_zone(spark, conf, rows):
    expected = rows(driver_history(_orders(spark), "2024-05-03 08:00:00"))
    utc = _orders(spark).withColumn("created_at", wall_instant("created_at"))
    conf(spark__sql__session__timeZone="America/New_York")
    assert dict(utc.dtypes)["created_at"] == "timestamp"
    assert rows(driver_history(utc, "2024-05-03 08:00:00")) == expected
    as_of = spark.sql("SELECT timestamp_ntz'2024-05-03 08:00:00' AS t")
    assert rows(driver_history(utc, as_of)) == expected


def test_drivers_default_to_now(spark):
    orders = spark.sql("""SELECT id, now() - make_dt_interval(int(id)) AS created_at FROM range(-2, 6)""")
    history = {r.id for r in driver_history(orders).collect()}
    recent = {r.id for r in driver_recent(orders).collect()}
    assert history == {1, 2, 3, 4, 5} and recent == {-2, -1, 0, 1}
