"""The two builds over the provided tables, as specs."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from snapline.plans import assemble
from snapline.plans.run import PipelineSpec, collect_sources
from snapline.plans.snapshot import Rules
from snapline.sources import tables
from snapline.sources.readers import SourceSpec

# The contract of an order snapshot. History must not be empty; in the
# morning there may be no recent order yet.
EXPECTED_COLUMNS = ("report_period_id", "entry_date", "id", "customer_id", "status", "created_at")


def _parquet(sf_dir: str, name: str, table: str, shape) -> SourceSpec:
    path = f"{sf_dir}/{table}.parquet"
    return SourceSpec(name, "parquet", path, shape=shape, schema=tables.schema_of(SparkSession.active(), path))


def history_spec(sf_dir: str, width: str = assemble.HISTORY_WIDTH, **extra) -> PipelineSpec:
    def driver(orders: DataFrame) -> DataFrame:
        as_of = tables.newest_order_time(orders.sparkSession, sf_dir)
        return assemble.driver_history(tables.customer_orders(orders), as_of)

    def crm(lineitem: DataFrame) -> DataFrame:
        return tables.crm_orders(lineitem, tables.table(lineitem.sparkSession, sf_dir, "orders"))

    return PipelineSpec(
        name="history",
        sources=(
            _parquet(sf_dir, "customer_orders", "orders", driver),
            _parquet(sf_dir, "cust_order_full", "lineitem", crm),
            _parquet(sf_dir, "crm_cust_order_ids", "lineitem", tables.crm_order_ids),
            _parquet(sf_dir, "crm_customer", "customer", tables.crm_customers),
        ),
        driver="customer_orders",
        assemble=partial(assemble.assemble_history, width=width, tiebreak=tables.HISTORY_TIEBREAK),
        rules=Rules(EXPECTED_COLUMNS, min_rows=1),
        **extra,
    )


def recent_spec(sf_dir: str, **extra) -> PipelineSpec:
    def driver(orders: DataFrame) -> DataFrame:
        as_of = tables.newest_order_time(orders.sparkSession, sf_dir)
        return assemble.driver_recent(tables.customer_orders(orders), as_of)

    def names(table: str, key: str, as_key: str, label: str, name: str) -> SourceSpec:
        return _parquet(
            sf_dir, name, table, lambda df: df.selectExpr(f"{key} AS {as_key}", f"{label} AS name")
        )

    return PipelineSpec(
        name="recent",
        sources=(
            _parquet(sf_dir, "customer_orders", "orders", driver),
            _parquet(sf_dir, "cust_order_day", "lineitem", tables.crm_day),
            _parquet(sf_dir, "crm_customer", "customer", tables.crm_customers),
            names("part", "p_partkey", "id", "p_type", "order_types"),
            names("nation", "n_nationkey", "cust_order_status_id", "n_name", "order_statuses"),
            names("supplier", "s_suppkey", "id", "s_name", "sales_channels"),
            names("region", "r_regionkey", "po_reject_reason_id", "r_name", "reject_reasons"),
            names("part", "p_partkey", "id", "p_name", "product_offers"),
        ),
        driver="customer_orders",
        assemble=partial(assemble.assemble_recent, tiebreak=tables.RECENT_TIEBREAK),
        rules=Rules(EXPECTED_COLUMNS, min_rows=0),
        **extra,
    )


def history_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return collect_sources(spark, history_spec(sf_dir))


def recent_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return collect_sources(spark, recent_spec(sf_dir))
