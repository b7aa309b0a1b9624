"""The provided tables, mapped to the order, CRM and metric models.

Whole tables throughout: a model renames, casts and joins, it never samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapline.functions.dates import fmt_day, fmt_ts
from snapline.operators.metrics import project

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# The order priority that stands for "not handed to the CRM yet": the key is NULL.
NOT_HANDED_OVER = "4-NOT SPECIFIED"
REGISTERED_FLAG = "R"


_schemas: dict[str, StructType] = {}


def schema_of(spark: SparkSession, path: str) -> StructType:
    """The schema a provided table was first read with; these tables never change."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return _schemas[path]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(schema_of(spark, path)).parquet(path)


def newest_order_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``as_of`` for the driver filters, one row: taken from the data, never the wall clock."""
    return table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("as_of"))


def customer_orders(orders: DataFrame) -> DataFrame:
    """The driver: every order, ``created_at`` in UTC."""
    handed_over = F.when(F.col("o_orderpriority") != NOT_HANDED_OVER, F.col("o_orderkey"))
    return project(orders, {
        "id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "crm_order_id": handed_over,
        "status": F.col("o_orderstatus"),
        "created_at": F.col("o_orderdate"),
    })


def crm_order_ids(lineitem: DataFrame) -> DataFrame:
    """Ids the CRM knows, as DOUBLE: orders with a returned line."""
    known = lineitem.where(F.col("l_returnflag") == REGISTERED_FLAG)
    return known.select(F.col("l_orderkey").cast("double").alias("id"))


def crm_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The CRM history: every order line, keyed by its customer as DOUBLE."""
    header = orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    rows = lineitem.join(header, F.col("l_orderkey") == F.col("o_orderkey"))
    return project(rows, {
        "customer_id": F.col("o_custkey").cast("double"),
        "order_date_create": F.col("l_shipdate"),
        "order_close_date": F.col("l_shipdate") + F.make_dt_interval("l_linenumber"),
        "type_name": F.col("o_orderpriority"),
        "status_name": F.col("l_linestatus"),
        "sales_channel_name": F.col("l_returnflag"),
        "username_created_order": F.col("l_suppkey").cast("string"),
        "reject_reason_name": F.col("o_orderstatus"),
        "new_product_offer_id": F.col("l_partkey").cast("double"),
        "new_product_offer_name": F.concat(F.lit("part "), F.col("l_partkey").cast("string")),
        "cust_order_id": F.col("l_orderkey").cast("string"),
        "customer_account_id": F.col("l_suppkey").cast("double"),
        "comments": F.concat(F.lit("line "), F.col("l_linenumber").cast("string")),
        "comment_on_close": F.concat(F.lit("qty "), F.col("l_quantity").cast("bigint").cast("string")),
    })


HISTORY_TIEBREAK = ("cust_order_id", "new_product_offer_id", "customer_account_id", "comments", "comment_on_close")


def crm_customers(customer: DataFrame) -> DataFrame:
    return project(customer, {
        "customer_id": F.col("c_custkey").cast("double"),
        "name": F.col("c_name"),
        "identification_number": F.concat(F.col("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string")),
        "mobile_phone": F.col("c_nationkey").cast("string"),
    })


def crm_day(lineitem: DataFrame) -> DataFrame:
    """CRM order states, several per id, times as text and codes as DOUBLE."""
    return project(lineitem, {
        "id": F.col("l_orderkey").cast("double"),
        "customer_account_id": F.col("l_suppkey").cast("double"),
        "new_product_offer_id": F.col("l_partkey").cast("double"),
        "cust_order_type_id": F.col("l_partkey").cast("double"),
        "status_id": F.col("l_linenumber").cast("double"),
        "sales_channel_id": F.col("l_suppkey").cast("double"),
        "reject_reason_id": F.col("l_linenumber").cast("double"),
        "create_date": fmt_ts("l_shipdate"),
        "change_status_date": fmt_ts(F.col("l_shipdate") + F.make_dt_interval("l_linenumber")),
        "update_date": fmt_ts("l_shipdate"),
        "create_user": F.col("l_suppkey").cast("string"),
        "comments": F.concat(F.lit("line "), F.col("l_linenumber").cast("string")),
        "comment_on_close": F.concat(F.lit("qty "), F.col("l_quantity").cast("bigint").cast("string")),
    })


RECENT_TIEBREAK = ("status_id", "new_product_offer_id", "customer_account_id", "comment_on_close")


def decode_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five id -> name tables; line numbers above the last region decode to NULL."""
    def names(name: str, key: str, as_key: str, label: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.col(key).alias(as_key), F.col(label).alias("name"))

    return {
        "order_types": names("part", "p_partkey", "id", "p_type"),
        "order_statuses": names("nation", "n_nationkey", "cust_order_status_id", "n_name"),
        "sales_channels": names("supplier", "s_suppkey", "id", "s_name"),
        "reject_reasons": names("region", "r_regionkey", "po_reject_reason_id", "r_name"),
        "product_offers": names("part", "p_partkey", "id", "p_name"),
    }


def snapshot_data(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """A snapshot for dashboards and the grid: every order with its customer."""
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return project(rows, {
        "id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "status": F.col("o_orderstatus"),
        "created_at": F.col("o_orderdate"),
        "entry_date": fmt_day("o_orderdate"),
        "name": F.col("c_name"),
        "type_name": F.when(F.col("o_orderpriority") != NOT_HANDED_OVER, F.col("o_orderpriority")),
        "segment": F.col("c_mktsegment"),
        "sales_channel_name": F.col("n_name"),
        "amount": F.col("o_totalprice").cast("decimal(18,2)"),
        "recreated_order": F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0),
    })


def metric_events(events: DataFrame) -> DataFrame:
    """Metric events; as in the source, column ``metrics`` holds the platform."""
    return project(events, {
        "metrics": F.when(F.col("value") >= 35, "A").otherwise("B"),
        "event_type": F.col("event_type"),
        "entry_date": fmt_day("ts"),
        "event_time": fmt_ts("ts"),
        "user_id": F.col("user_id"),
        "status": F.col("event_type"),
    })


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A model by name."""
    def t(table_name: str) -> DataFrame:
        return table(spark, sf_dir, table_name)

    if name == "customer_orders":
        return customer_orders(t("orders"))
    if name == "crm_cust_order_ids":
        return crm_order_ids(t("lineitem"))
    if name == "cust_order_full":
        return crm_orders(t("lineitem"), t("orders"))
    if name == "crm_customer":
        return crm_customers(t("customer"))
    if name == "cust_order_day":
        return crm_day(t("lineitem"))
    if name == "data":
        return snapshot_data(t("orders"), t("customer"), t("nation"))
    if name == "metric_events":
        return metric_events(t("events"))
    raise KeyError(name)
