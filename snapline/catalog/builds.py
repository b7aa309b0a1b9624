"""Builds, assemblies, their joins and ranks, scans and snapshots."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.catalog import models as m
from snapline.catalog.pipelines import (
    EXPECTED_COLUMNS, history_frames, history_spec, recent_frames, recent_spec,
)
from snapline.catalog.registry import query
from snapline.functions.dates import fmt_day, fmt_ts, local_time, period_id, read_time
from snapline.functions.keys import key_of, safe_bigint, to_key
from snapline.operators.joins import anti_not_in, decode, left_by_key, left_window, semi_window
from snapline.operators.latest import latest_by
from snapline.operators.metrics import project
from snapline.operators.profile import validate_report
from snapline.operators.protect import decrypt_columns, encrypt_columns, key_from_file, mask
from snapline.operators.pushdown import distinct_ids, key_stats, restrict_to_keys, restrict_to_range
from snapline.plans import assemble
from snapline.plans.days import read_days, run_days
from snapline.plans.run import run_pipeline
from snapline.plans.snapshot import (
    Manifest, Rules, read_manifest, read_snapshot, snapshot_views, table_counts, write_snapshot,
)
from snapline.session import scratch
from snapline.sources import files, tables
from snapline.sources.readers import SourceSpec, read_source

DAYS = 30


# --- assemblies -----------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str, width: str = f"{DAYS} days") -> DataFrame:
    return assemble.assemble_history(history_frames(spark, sf_dir), width, tables.HISTORY_TIEBREAK)


@query("assemble_history", m.history_sql(DAYS))
def _(spark, d):
    return flagship(spark, d)


@query("assemble_history_day", m.history_sql(1))
def _(spark, d):
    return flagship(spark, d, assemble.HISTORY_WIDTH)


@query("assemble_recent", m.RECENT_SQL)
def _(spark, d):
    return assemble.assemble_recent(recent_frames(spark, d), tables.RECENT_TIEBREAK)


def _key(spark: SparkSession):
    path = f"{scratch(spark, 'key')}.bin"
    files.write_bytes(spark, path, bytes(range(32)))
    return key_from_file(spark, path)


def _checked(manifest: Manifest) -> None:
    if manifest.error:
        raise RuntimeError(manifest.error)


def _built(spark: SparkSession, spec) -> DataFrame:
    path = scratch(spark, spec.name)
    _checked(run_pipeline(spark, spec, path))
    return read_snapshot(spark, path)


@query("build_history", m.history_sql(DAYS))
def _(spark, d):
    return _built(spark, history_spec(d, width=f"{DAYS} days", export=assemble.history_sources))


@query("build_history_by_day", m.history_sql(DAYS))
def _(spark, d):
    """A history kept by month: the second build finds the orders of late months changed and writes only these."""
    path, spec = scratch(spark, "days"), history_spec(d, f"{DAYS} days")
    late = F.col("entry_date") >= "1998-01-01"
    run_days(spark, spec, path, grain="month", made=lambda df: df.withColumn("status", F.when(late, "?").otherwise(F.col("status"))))
    run_days(spark, spec, path, grain="month")
    return read_days(spark, path)


@query("build_recent", m.RECENT_SQL)
def _(spark, d):
    export = partial(assemble.recent_sources, tiebreak=tables.RECENT_TIEBREAK)
    return _built(spark, recent_spec(d, export=export))


@query("build_after_failure", m.RECENT_SQL)
def _(spark, d):
    """A build that breaks its contract after a good one: readers still get the good one."""
    path = scratch(spark, "failing")
    run_pipeline(spark, recent_spec(d), path)
    broken = replace(recent_spec(d), rules=Rules(("no such column",)))
    if run_pipeline(spark, broken, path, keep=1).error is None:
        raise RuntimeError("the broken build should have failed")
    return read_snapshot(spark, path)


_SOURCE_COUNTS = m.with_(m.CUSTOMER_ORDERS, m.DRIVER_HISTORY, m.CRM_IDS) + """
SELECT 'data' AS table_name, count(*) AS row_count FROM driver d
  WHERE crm_order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM crm_ids WHERE k = d.crm_order_id)
UNION ALL SELECT 'customer_orders', count(*) FROM driver
UNION ALL SELECT 'cust_order_full', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE EXISTS (SELECT 1 FROM driver WHERE customer_id = o_custkey)
UNION ALL SELECT 'crm_cust_order_ids', count(*) FROM crm_ids WHERE EXISTS (SELECT 1 FROM driver WHERE crm_order_id = k)
UNION ALL SELECT 'crm_customer', count(*) FROM customer WHERE EXISTS (SELECT 1 FROM driver WHERE customer_id = c_custkey)"""


@query("build_history_sources", _SOURCE_COUNTS)
def _(spark, d):
    path = scratch(spark, "sources")
    _checked(run_pipeline(spark, history_spec(d, export=assemble.history_sources), path))
    return table_counts(snapshot_views(spark, path))


@query("build_recent_sources", m.with_(m.CUSTOMER_ORDERS, m.DRIVER_RECENT, m.DAY_LATEST) + """
SELECT 'data' AS table_name, count(*) AS row_count FROM driver
UNION ALL SELECT 'customer_orders', count(*) FROM driver
UNION ALL SELECT 'cust_order_day_detail', count(*) FROM day_latest WHERE EXISTS (SELECT 1 FROM driver WHERE crm_order_id = l_orderkey)
UNION ALL SELECT 'crm_customer', count(*) FROM customer WHERE EXISTS (SELECT 1 FROM driver WHERE customer_id = c_custkey)""")
def _(spark, d):
    path = scratch(spark, "sources")
    export = partial(assemble.recent_sources, tiebreak=tables.RECENT_TIEBREAK)
    _checked(run_pipeline(spark, recent_spec(d, export=export), path))
    return table_counts(snapshot_views(spark, path))


@query("build_history_encrypted", m.history_sql(DAYS))
def _(spark, d):
    path = scratch(spark, "encrypted")
    key = _key(spark)
    spec = history_spec(d, width=f"{DAYS} days", encrypt=assemble.PERSONAL_COLUMNS)
    manifest = run_pipeline(spark, spec, path, key)
    if manifest.error or not manifest.encrypted:
        raise RuntimeError(manifest.error or "nothing was encrypted")
    return read_snapshot(spark, path, key)


# --- scans ----------------------------------------------------------------------

@query("scan_driver", m.with_(m.CUSTOMER_ORDERS) + "SELECT * FROM customer_orders")
def _(spark, d):
    return read_source(spark, SourceSpec("customer_orders", "parquet", f"{d}/orders.parquet", shape=tables.customer_orders))


@query("scan_warehouse", """SELECT l_orderkey AS id, l_shipdate AS update_date, l_linestatus AS status,
  l_partkey AS new_product_offer_id FROM lineitem""")
def _(spark, d):
    def shape(df):
        return project(df, {
            "id": F.col("l_orderkey"), "update_date": F.col("l_shipdate"),
            "status": F.col("l_linestatus"), "new_product_offer_id": F.col("l_partkey"),
        })

    return read_source(spark, SourceSpec("lines", "parquet", f"{d}/lineitem.parquet", shape=shape))


@query("source_table_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables.TABLES))
def _(spark, d):
    return table_counts({t: tables.table(spark, d, t) for t in tables.TABLES})


@query("project_enrichment", """SELECT l_orderkey AS cust_order_id, l_shipdate AS order_date_create,
  l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS order_close_date, l_returnflag AS sales_channel_name
FROM lineitem""")
def _(spark, d):
    lines = tables.table(spark, d, "lineitem")
    text = project(lines, {
        "cust_order_id": F.col("l_orderkey"),
        "created": fmt_ts("l_shipdate"),
        "closed": fmt_ts(F.col("l_shipdate") + F.make_dt_interval("l_linenumber")),
        "sales_channel_name": F.col("l_returnflag"),
    })
    return project(text, {
        "cust_order_id": F.col("cust_order_id"),
        "order_date_create": read_time("created"),
        "order_close_date": read_time("closed"),
        "sales_channel_name": F.col("sales_channel_name"),
    })


# --- drivers and pushdown --------------------------------------------------------

@query("driver_history", m.with_(m.CUSTOMER_ORDERS, m.DRIVER_HISTORY) + "SELECT * FROM driver")
def _(spark, d):
    return assemble.driver_history(tables.model(spark, d, "customer_orders"), tables.newest_order_time(spark, d))


@query("driver_recent", m.with_(m.CUSTOMER_ORDERS, m.DRIVER_RECENT) + "SELECT * FROM driver")
def _(spark, d):
    return assemble.driver_recent(tables.model(spark, d, "customer_orders"), tables.newest_order_time(spark, d))


@query("key_pushdown", m.with_(m.CUSTOMER_ORDERS) + """SELECT lineitem.* FROM lineitem
WHERE EXISTS (SELECT 1 FROM customer_orders WHERE crm_order_id = l_orderkey)""")
def _(spark, d):
    return restrict_to_keys(
        tables.table(spark, d, "lineitem"), "l_orderkey", tables.model(spark, d, "customer_orders"), "crm_order_id"
    )


@query("range_pushdown", """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate BETWEEN (SELECT min(o_orderdate) FROM orders) AND (SELECT max(o_orderdate) FROM orders)""")
def _(spark, d):
    lines = tables.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return restrict_to_range(lines, "l_shipdate", tables.model(spark, d, "customer_orders"), "created_at")


@query("key_stats", m.with_(m.CUSTOMER_ORDERS) + """SELECT
  count(DISTINCT customer_id) AS customer_id_ids, min(customer_id) AS customer_id_min, max(customer_id) AS customer_id_max,
  count(DISTINCT crm_order_id) AS crm_order_id_ids, min(crm_order_id) AS crm_order_id_min, max(crm_order_id) AS crm_order_id_max
FROM customer_orders""")
def _(spark, d):
    return key_stats(tables.model(spark, d, "customer_orders"), ["customer_id", "crm_order_id"])


@query("distinct_ids", m.with_(m.CRM_IDS) + "SELECT k AS id FROM crm_ids")
def _(spark, d):
    return distinct_ids(tables.model(spark, d, "crm_cust_order_ids"), "id")


# --- joins and ranks --------------------------------------------------------------

@query("join_direct", m.with_(m.CUSTOMER_ORDERS, m.DAY_LATEST) + """SELECT id, customer_id, crm_order_id,
  l_orderkey AS cust_order_id, l_shipdate AS update_date
FROM customer_orders LEFT JOIN day_latest ON crm_order_id = l_orderkey""")
def _(spark, d):
    orders = tables.model(spark, d, "customer_orders").select("id", "customer_id", "crm_order_id")
    day = latest_by(tables.model(spark, d, "cust_order_day"), ["id"], ["update_date"], tables.RECENT_TIEBREAK)
    states = day.select(to_key("id").alias("key"), to_key("id").alias("cust_order_id"), read_time("update_date").alias("update_date"))
    return left_by_key(orders, states, "crm_order_id", "key", split_nulls=True)


@query("join_customer", m.with_(m.CUSTOMER_ORDERS, m.CRM_CUSTOMERS) + """SELECT id, customer_id, name, identification_number
FROM customer_orders LEFT JOIN crm_customers ON customer_key = customer_id""")
def _(spark, d):
    people = tables.model(spark, d, "crm_customer").select(to_key("customer_id").alias("key"), "name", "identification_number")
    return left_by_key(tables.model(spark, d, "customer_orders").select("id", "customer_id"), people, "customer_id", "key")


def _unregistered(spark: SparkSession, d: str) -> DataFrame:
    orders = tables.model(spark, d, "customer_orders")
    ids = tables.model(spark, d, "crm_cust_order_ids").select(to_key("id").alias("id"))
    return anti_not_in(orders, "crm_order_id", ids, "id")


_OPEN = m.with_(m.CUSTOMER_ORDERS, m.CRM_IDS, "driver AS (SELECT * FROM customer_orders)", m.UNREGISTERED,
                m.CRM_ORDERS, m.newest_sql(DAYS))


@query("anti_not_registered", m.with_(m.CUSTOMER_ORDERS, m.CRM_IDS) +
       "SELECT * FROM customer_orders WHERE crm_order_id NOT IN (SELECT k FROM crm_ids)")
def _(spark, d):
    return _unregistered(spark, d)


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    crm = tables.model(spark, d, "cust_order_full").withColumn("customer_key", to_key("customer_id"))
    windows = _unregistered(spark, d).select(F.col("customer_id").alias("customer_key"), F.col("created_at").alias("opened"))
    return semi_window(crm, windows, "customer_key", "order_date_create", "opened", f"{DAYS} days")


@query("semi_window", _OPEN + """SELECT customer_key, order_date_create, cust_order_id, comments FROM crm_orders c
WHERE EXISTS (SELECT 1 FROM unregistered u WHERE u.customer_id = c.customer_key
  AND c.order_date_create BETWEEN u.created_at AND u.created_at + INTERVAL 30 DAY)""")
def _(spark, d):
    return _candidates(spark, d).select("customer_key", "order_date_create", "cust_order_id", "comments")


@query("latest_per_customer", _OPEN + "SELECT customer_key, order_date_create, cust_order_id, comments FROM newest")
def _(spark, d):
    newest = latest_by(_candidates(spark, d), ["customer_key"], ["order_date_create"], tables.HISTORY_TIEBREAK)
    return newest.select("customer_key", "order_date_create", "cust_order_id", "comments")


@query("interval_left", _OPEN + """SELECT id, customer_id, created_at, order_date_create, cust_order_id
FROM unregistered LEFT JOIN newest ON customer_key = customer_id
  AND order_date_create BETWEEN created_at AND created_at + INTERVAL 30 DAY""")
def _(spark, d):
    newest = latest_by(_candidates(spark, d), ["customer_key"], ["order_date_create"], tables.HISTORY_TIEBREAK)
    newest = newest.select("customer_key", "order_date_create", "cust_order_id")
    orders = _unregistered(spark, d).select("id", "customer_id", "created_at")
    return left_window(orders, newest, "customer_id", "customer_key", "created_at", "order_date_create", f"{DAYS} days")


@query("latest_state", m.with_(m.DAY_LATEST) + "SELECT * FROM day_latest")
def _(spark, d):
    lines = tables.table(spark, d, "lineitem")
    return latest_by(lines, ["l_orderkey"], ["l_shipdate"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])


@query("star_decode", """SELECT l_orderkey AS id, pt.p_type AS type_name, n_name AS status_name,
  s_name AS sales_channel_name, r_name AS reject_reason_name, pt.p_name AS new_product_offer_name
FROM lineitem LEFT JOIN part pt ON l_partkey = pt.p_partkey LEFT JOIN nation ON l_linenumber = n_nationkey
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN region ON l_linenumber = r_regionkey""")
def _(spark, d):
    dims = tables.decode_tables(spark, d)
    day = tables.model(spark, d, "cust_order_day")
    named = decode(day, [
        ("cust_order_type_id", dims["order_types"], "id", "name", "type_name"),
        ("status_id", dims["order_statuses"], "cust_order_status_id", "name", "status_name"),
        ("sales_channel_id", dims["sales_channels"], "id", "name", "sales_channel_name"),
        ("reject_reason_id", dims["reject_reasons"], "po_reject_reason_id", "name", "reject_reason_name"),
        ("new_product_offer_id", dims["product_offers"], "id", "name", "new_product_offer_name"),
    ])
    return named.select(
        to_key("id").alias("id"), "type_name", "status_name", "sales_channel_name", "reject_reason_name",
        "new_product_offer_name",
    )


# --- scalars ------------------------------------------------------------------------

@query("scalar_dates", f"""SELECT o_orderkey AS id, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS period_id,
  strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS second,
  {m.local('o_orderdate')} AS local_time, o_orderdate + INTERVAL 1 DAY AS next_day FROM orders""")
def _(spark, d):
    return project(tables.table(spark, d, "orders"), {
        "id": F.col("o_orderkey"), "period_id": period_id("o_orderdate"), "day": fmt_day("o_orderdate"),
        "second": fmt_ts("o_orderdate"), "local_time": local_time("o_orderdate"),
        "next_day": F.col("o_orderdate") + F.expr("interval 1 day"),
    })


@query("scalar_casts", """SELECT l_orderkey, l_linenumber, CAST(l_quantity * 0.5 AS BIGINT) AS from_double,
  TRY_CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS BIGINT) AS from_decimal_text,
  TRY_CAST(l_returnflag AS BIGINT) AS from_word, TRY_CAST(' ' || l_partkey || ' ' AS BIGINT) AS from_padded
FROM lineitem""")
def _(spark, d):
    money = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return project(tables.table(spark, d, "lineitem"), {
        "l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber"),
        "from_double": to_key(F.col("l_quantity") * 0.5),
        "from_decimal_text": safe_bigint(money),
        "from_word": safe_bigint("l_returnflag"),
        "from_padded": safe_bigint(F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" "))),
    })


# --- snapshots ------------------------------------------------------------------------

@query("snapshot_roundtrip", m.with_(m.DATA) + "SELECT * FROM data")
def _(spark, d):
    path = scratch(spark, "roundtrip")
    write_snapshot(tables.model(spark, d, "data"), path)
    return read_snapshot(spark, path)


@query("snapshot_scan", m.with_(m.DATA) + """SELECT 'data' AS table_name, status, count(*) AS n FROM data GROUP BY 2
UNION ALL SELECT 'customer_orders', o_orderstatus, count(*) FROM orders GROUP BY 2""")
def _(spark, d):
    path = scratch(spark, "scan")
    write_snapshot(
        tables.model(spark, d, "data"), path, sources={"customer_orders": tables.model(spark, d, "customer_orders")}
    )
    snapshot_views(spark, path)
    return spark.sql("""SELECT 'data' AS table_name, status, count(*) AS n FROM data GROUP BY 2
        UNION ALL SELECT 'customer_orders', status, count(*) FROM customer_orders GROUP BY 2""")


@query("snapshot_profile", """SELECT p.position, p.column_name, p.type, n.row_count, 'ok' AS status
FROM (VALUES (1,'id','bigint'),(2,'customer_id','bigint'),(3,'status','string'),(4,'created_at','timestamp_ntz'),
  (5,'entry_date','string'),(6,'name','string'),(7,'type_name','string'),(8,'segment','string'),
  (9,'sales_channel_name','string'),(10,'amount','decimal(18,2)'),(11,'recreated_order','int'))
  AS p(position, column_name, type), (SELECT count(*) AS row_count FROM orders) n""")
def _(spark, d):
    path = scratch(spark, "profile")
    write_snapshot(tables.model(spark, d, "data"), path)
    manifest = spark.read.option("multiLine", True).json(f"{path}/manifest.json")
    cells = manifest.select("row_count", "status", F.posexplode("columns").alias("at", "c"))
    return cells.select(
        (F.col("at") + 1).alias("position"), F.col("c.name").alias("column_name"), F.col("c.type").alias("type"),
        "row_count", "status",
    )


@query("validate_report", m.with_(m.DATA) + """SELECT 'expected_columns' AS rule, false AS passed, 'report_period_id' AS value
UNION ALL SELECT 'min_rows', count(*) >= 1, CAST(count(*) AS VARCHAR) FROM data
UNION ALL SELECT 'max_rows', count(*) <= 50000, CAST(count(*) AS VARCHAR) FROM data""")
def _(spark, d):
    # `data` has no period column, and the bound is the one a browser-sized snapshot has.
    return validate_report(tables.model(spark, d, "data"), EXPECTED_COLUMNS, min_rows=1, max_rows=50_000)


# --- protection --------------------------------------------------------------------------

@query("encrypt_roundtrip", m.with_(m.CRM_CUSTOMERS) + """SELECT customer_key, name, identification_number, mobile_phone,
  28 + strlen(name) AS name_bytes FROM crm_customers""")
def _(spark, d):
    key = _key(spark)
    people = tables.model(spark, d, "crm_customer").withColumn("customer_key", to_key("customer_id")).drop("customer_id")
    closed = encrypt_columns(people, assemble.PERSONAL_COLUMNS, key)
    closed = closed.withColumn("name_bytes", F.octet_length("name").cast("bigint"))
    return decrypt_columns(closed, assemble.PERSONAL_COLUMNS, key)


@query("masked_snapshot", m.with_(m.DATA) + """SELECT id, sha256(CAST(customer_id AS VARCHAR)) AS customer_id, status, created_at,
  entry_date, type_name, segment, sales_channel_name, amount, recreated_order FROM data""")
def _(spark, d):
    return mask(tables.model(spark, d, "data"), {"name": "drop", "customer_id": "hash"})
