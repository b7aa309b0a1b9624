"""Metrics, dashboards, the grid, ad-hoc SQL, exports and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.catalog import models as m
from snapline.catalog.registry import query
from snapline.functions.dates import fmt_day
from snapline.functions.predicates import has_text, not_like_any, whitelist
from snapline.operators import adhoc as sql_
from snapline.operators import dashboard as dash
from snapline.operators import grid, sketches
from snapline.operators.export import csv_lines
from snapline.operators.metrics import metric_counts, normalize_metrics, project, sample_series, union_all
from snapline.operators.profile import column_profile, numeric_columns
from snapline.plans.pages import Pages, write_pages
from snapline.plans.snapshot import read_sketches, search_snapshot, snapshot_views, write_snapshot
from snapline.session import scratch
from snapline.sources import tables
from snapline.streaming import refresh

ALLOWED = {"A": None, "B": ["click", "view"]}
EXCLUDED = ["sign_p%", "err_r%"]


def _data(spark: SparkSession, d: str) -> DataFrame:
    return tables.model(spark, d, "data")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return tables.model(spark, d, "metric_events")


# --- metrics -------------------------------------------------------------------------

_BRANCHES = """branch_a AS (
  SELECT metrics AS platform, event_type AS metrics, entry_date, count(*) AS cnt FROM metric_events
  WHERE event_type <> '' AND (metrics = 'A' OR (metrics = 'B' AND event_type IN ('click', 'view')))
  GROUP BY ALL),
branch_l AS (
  SELECT 'L' AS platform, event_type AS metrics, left(event_time, 10) AS entry_date, count(*) AS cnt FROM metric_events
  WHERE event_type <> '' AND event_type NOT LIKE 'sign_p%' AND event_type NOT LIKE 'err_r%'
  GROUP BY ALL)"""


def _all_counts(spark: SparkSession, d: str) -> DataFrame:
    events = _events(spark, d)
    listed = metric_counts(
        events, F.col("metrics"), "event_type", F.col("entry_date"), whitelist("metrics", "event_type", ALLOWED)
    )
    rest = metric_counts(
        events, F.lit("L"), "event_type", F.left(F.col("event_time"), F.lit(10)), not_like_any("event_type", EXCLUDED)
    )
    return union_all([listed, rest])


@query("metric_counts", m.with_(m.EVENTS, _BRANCHES) + "SELECT * FROM branch_a UNION ALL SELECT * FROM branch_l")
def _(spark, d):
    return _all_counts(spark, d)


@query("whitelist_filter", m.with_(m.EVENTS) + """SELECT user_id, metrics, event_type, event_time FROM metric_events
WHERE metrics = 'A' OR (metrics = 'B' AND event_type IN ('click', 'view'))""")
def _(spark, d):
    kept = _events(spark, d).where(whitelist("metrics", "event_type", ALLOWED))
    return kept.select("user_id", "metrics", "event_type", "event_time")


@query("notlike_filter", m.with_(m.EVENTS) + """SELECT user_id, event_type, event_time FROM metric_events
WHERE event_type IS NOT NULL AND event_type <> '' AND NOT (event_type LIKE 'sign_p%' OR event_type LIKE 'err_r%')""")
def _(spark, d):
    kept = _events(spark, d).where(has_text("event_type") & not_like_any("event_type", EXCLUDED))
    return kept.select("user_id", "event_type", "event_time")


@query("combine_union", m.with_(m.EVENTS, m.DATA) + """SELECT 'A' AS platform, event_type AS metrics, entry_date,
  CAST(count(*) AS VARCHAR) AS cnt, NULL AS amount FROM metric_events GROUP BY 2, 3
UNION ALL SELECT NULL, status, entry_date, NULL, sum(amount) FROM data GROUP BY 2, 3""")
def _(spark, d):
    counted = metric_counts(_events(spark, d), F.lit("A"), "event_type", F.col("entry_date"))
    counted = counted.withColumn("cnt", F.col("cnt").cast("string"))
    summed = _data(spark, d).groupBy("entry_date", F.col("status").alias("metrics")).agg(F.sum("amount").cast("decimal(38,2)").alias("amount"))
    return union_all([counted, summed])


@query("normalize_metrics", """SELECT CAST(l_suppkey AS VARCHAR) AS platform, l_returnflag AS metrics,
  strftime(l_shipdate, '%Y-%m-%d') AS entry_date,
  CAST(CASE WHEN l_returnflag = 'A' THEN 0 ELSE trunc(l_quantity * 1.3) END AS BIGINT) AS cnt FROM lineitem""")
def _(spark, d):
    lines = tables.table(spark, d, "lineitem")
    raw = project(lines, {
        "platform": F.col("l_suppkey"),
        "metrics": F.col("l_returnflag"),
        "entry_date": fmt_day("l_shipdate"),
        "cnt": F.when(F.col("l_returnflag") == "A", "n/a").otherwise((F.col("l_quantity") * 1.3).cast("string")),
    })
    return normalize_metrics(raw)


@query("sample_series", m.with_(m.EVENTS, """catalogue AS (
  SELECT metrics AS platform, event_type AS metrics, count(*) AS seed FROM metric_events GROUP BY 1, 2)""", """steps AS (
  SELECT platform, metrics, seed, back, 50 + (seed * 7919 + back * 104729) % 4951 AS base
  FROM catalogue, range(60) AS r(back))""") + """SELECT platform, metrics,
  strftime(DATE '2024-01-30' - CAST(back AS INTEGER), '%Y-%m-%d') AS entry_date,
  CAST((base * (180 - back)) // 120 + (seed * 31 + back * 17) % (2 * (base // 5) + 1) - base // 5 AS BIGINT) AS cnt FROM steps""")
def _(spark, d):
    catalogue = _events(spark, d).groupBy(F.col("metrics").alias("platform"), F.col("event_type").alias("metrics"))
    return sample_series(catalogue.agg(F.count(F.lit(1)).alias("seed")), "2024-01-30")


# --- dashboards ------------------------------------------------------------------------

# Aggregates and fields of the order dashboard.
ORDER_DASHBOARD = {
    "filters": [{"field": "status"}, {"field": "sales_channel_name"}],
    "kpis": [
        {"agg": "count", "field": "id"},
        {"agg": "count_distinct", "field": "customer_id"},
        {"agg": "sum", "field": "recreated_order"},
        {"agg": "count_distinct", "field": "sales_channel_name"},
    ],
    "widgets": [
        {"type": "line", "x": "entry_date", "y": "id", "agg": "count"},
        {"type": "bar", "x": "status", "y": "id", "agg": "count"},
        {"type": "bar", "x": "sales_channel_name", "y": "id", "agg": "count"},
    ],
}
# Aggregates and fields of the promotion dashboard.
PROMO_DASHBOARD = {
    "filters": [
        {"field": "eligibility_status"},
        {"field": "promo_code"},
        {"field": "is_employee"},
    ],
    "kpis": [
        {"agg": "count", "field": "participation_number"},
        {"agg": "count_distinct", "field": "customer_id"},
        {"agg": "count_distinct", "field": "promo_code"},
        {"agg": "sum", "field": "has_services"},
    ],
    "widgets": [
        {"type": "line", "x": "entry_date", "y": "participation_number", "agg": "count"},
        {"type": "bar", "x": "eligibility_status", "y": "id", "agg": "count"},
        {"type": "bar", "x": "promo_code", "y": "participation_number", "agg": "count", "limit": 10},
    ],
}

PROMO = """promo AS (
  SELECT l_orderkey AS participation_number, o_custkey AS customer_id, 'P' || l_partkey AS promo_code,
         l_returnflag AS eligibility_status, o_orderstatus AS is_employee, CAST(l_tax > 0 AS INTEGER) AS has_services,
         strftime(l_shipdate, '%Y-%m-%d') AS entry_date, l_orderkey AS id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _promo(spark: SparkSession, d: str) -> DataFrame:
    header = tables.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    rows = tables.table(spark, d, "lineitem").join(header, F.col("l_orderkey") == F.col("o_orderkey"))
    return project(rows, {
        "participation_number": F.col("l_orderkey"), "customer_id": F.col("o_custkey"),
        "promo_code": F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
        "eligibility_status": F.col("l_returnflag"), "is_employee": F.col("o_orderstatus"),
        "has_services": (F.col("l_tax") > 0).cast("int"),
        "entry_date": fmt_day("l_shipdate"), "id": F.col("l_orderkey"),
    })


_KPIS = """SELECT CAST(count(id) AS DOUBLE) AS k0, CAST(count(DISTINCT customer_id) AS DOUBLE) AS k1,
  CAST(coalesce(sum(recreated_order), 0) AS DOUBLE) AS k2, CAST(count(DISTINCT sales_channel_name) AS DOUBLE) AS k3"""


@query("kpi_panel", m.with_(m.DATA) + _KPIS + ", round(avg(amount), 4) AS k4 FROM data")
def _(spark, d):
    specs = [*ORDER_DASHBOARD["kpis"], {"agg": "avg", "field": "amount"}]
    return dash.kpis(_data(spark, d), specs).withColumn("k4", F.round("k4", 4))


@query("kpi_filtered", m.with_(m.DATA) + _KPIS + " FROM data WHERE status = 'F' AND segment = 'BUILDING'")
def _(spark, d):
    filters = {"status": "F", "sales_channel_name": "__all__", "segment": "BUILDING", "type_name": ""}
    return dash.kpis(_data(spark, d), ORDER_DASHBOARD["kpis"], filters)


@query("promo_kpis", m.with_(PROMO) + """SELECT CAST(count(participation_number) AS DOUBLE) AS k0,
  CAST(count(DISTINCT customer_id) AS DOUBLE) AS k1, CAST(count(DISTINCT promo_code) AS DOUBLE) AS k2,
  CAST(sum(has_services) AS DOUBLE) AS k3 FROM promo""")
def _(spark, d):
    return dash.kpis(_promo(spark, d), PROMO_DASHBOARD["kpis"])


@query("agg_fallback", m.with_(m.DATA) + "SELECT status AS x, CAST(sum(recreated_order) AS DOUBLE) AS y FROM data GROUP BY 1")
def _(spark, d):
    return dash.bar(_data(spark, d), "status", "recreated_order", "median")


@query("equality_filters", m.with_(m.DATA) + "SELECT * FROM data WHERE status = 'O' AND customer_id = 7")
def _(spark, d):
    return dash.equality_filters(_data(spark, d), {"status": "O", "customer_id": "7", "segment": "__all__", "name": ""})


@query("dashboard_kpis", m.with_(m.DATA) + _KPIS + " FROM data WHERE status = 'O'")
def _(spark, d):
    return dash.dashboard(_data(spark, d), ORDER_DASHBOARD, {"status": "O"})["kpis"]


@query("dashboard_options", m.with_(m.DATA) + "SELECT DISTINCT sales_channel_name FROM data WHERE sales_channel_name IS NOT NULL")
def _(spark, d):
    return dash.dashboard(_data(spark, d), ORDER_DASHBOARD, {"status": "O"})["filters"]["sales_channel_name"]


@query("bar_by_status", m.with_(m.DATA) + "SELECT status AS x, CAST(count(id) AS DOUBLE) AS y FROM data GROUP BY 1")
def _(spark, d):
    w = ORDER_DASHBOARD["widgets"][1]
    return dash.bar(_data(spark, d), w["x"], w["y"], w["agg"])


@query("bar_by_channel", m.with_(m.DATA) + """SELECT sales_channel_name AS x, CAST(count(id) AS DOUBLE) AS y FROM data
WHERE status = 'O' GROUP BY 1""")
def _(spark, d):
    return dash.dashboard(_data(spark, d), ORDER_DASHBOARD, {"status": "O"})["widgets"][2]


@query("promo_by_eligibility", m.with_(PROMO) + "SELECT eligibility_status AS x, CAST(count(id) AS DOUBLE) AS y FROM promo GROUP BY 1")
def _(spark, d):
    return dash.dashboard(_promo(spark, d), PROMO_DASHBOARD)["widgets"][1]


@query("promo_by_day", m.with_(PROMO) + """SELECT entry_date AS x, 'all' AS s, CAST(count(participation_number) AS DOUBLE) AS y
FROM promo WHERE is_employee = 'F' GROUP BY 1""")
def _(spark, d):
    return dash.dashboard(_promo(spark, d), PROMO_DASHBOARD, {"is_employee": "F", "promo_code": "__all__"})["widgets"][0]


@query("bar_topn", m.with_(PROMO) + """SELECT promo_code AS x, CAST(count(participation_number) AS DOUBLE) AS y FROM promo
GROUP BY 1 ORDER BY y DESC, x NULLS LAST LIMIT 10""")
def _(spark, d):
    w = PROMO_DASHBOARD["widgets"][2]
    return dash.bar(_promo(spark, d), w["x"], w["y"], w["agg"], w["limit"])


@query("line_by_day", m.with_(m.DATA) + "SELECT entry_date AS x, 'all' AS s, CAST(count(id) AS DOUBLE) AS y FROM data GROUP BY 1")
def _(spark, d):
    return dash.dashboard(_data(spark, d), ORDER_DASHBOARD)["widgets"][0]


@query("line_dense", m.with_(m.DATA, """points AS (
  SELECT entry_date AS x, type_name AS s, CAST(count(id) AS DOUBLE) AS y FROM data GROUP BY 1, 2)""") + """
SELECT x, s, coalesce(max(y), 0) AS y FROM (
  SELECT * FROM points
  UNION ALL SELECT xs.x, ss.s, NULL FROM (SELECT DISTINCT x FROM points) xs, (SELECT DISTINCT s FROM points) ss)
GROUP BY x, s""")
def _(spark, d):
    return dash.line(_data(spark, d), "entry_date", "id", "count", series="type_name", dense=True)


LINE_SPEC = {"widgets": [{"type": "line", "x": "entry_date", "y": "amount", "agg": "sum", "series": "type_name"}]}


@query("dashboard_line_series", m.with_(m.DATA, """points AS (
  SELECT entry_date AS x, type_name AS s, round(CAST(sum(CASE WHEN status <> 'P' THEN amount END) AS DOUBLE), 2) AS y FROM data GROUP BY 1, 2)""") + """
SELECT xs.x, ss.s, coalesce(points.y, 0) AS y FROM (SELECT DISTINCT x FROM points) xs CROSS JOIN (SELECT DISTINCT s FROM points) ss
LEFT JOIN points ON points.x IS NOT DISTINCT FROM xs.x AND points.s IS NOT DISTINCT FROM ss.s""")
def _(spark, d):
    data = _data(spark, d).withColumn("amount", F.when(F.col("status") != "P", F.col("amount")))
    return dash.dashboard(data, LINE_SPEC)["widgets"][0].withColumn("y", F.round("y", 2))


@query("kpi_wide_sum", m.with_(m.DATA) + "SELECT CAST(sum(CAST(id AS HUGEINT) * 0 + 4611686018427387904) AS DOUBLE) AS k0 FROM data")
def _(spark, d):
    data = _data(spark, d).withColumn("huge", F.col("id") * 0 + F.lit(1 << 62))
    return dash.kpis(data, [{"agg": "sum", "field": "huge"}])


@query("filter_options", m.with_(m.DATA) + "SELECT DISTINCT type_name FROM data WHERE type_name IS NOT NULL")
def _(spark, d):
    return dash.filter_options(_data(spark, d), "type_name")


# --- grid --------------------------------------------------------------------------------

_ILIKE = " OR ".join(f"CAST({c} AS VARCHAR) ILIKE '%er%5_0%'" for c in (
    "id", "customer_id", "status", "created_at", "entry_date", "name", "type_name", "segment", "sales_channel_name",
    "amount", "recreated_order"))


@query("grid_search", m.with_(m.DATA) + f"SELECT * FROM data WHERE {_ILIKE}")
def _(spark, d):
    return grid.grid_search(_data(spark, d), " ER%5_0 ")


_LINE_ILIKE = " OR ".join(f"CAST({c} AS VARCHAR) ILIKE '%123.%'" for c in (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate"))


@query("grid_search_doubles", f"SELECT * FROM lineitem WHERE {_LINE_ILIKE}")
def _(spark, d):
    return grid.grid_search(tables.table(spark, d, "lineitem"), "123.")


@query("filter_values_doubles", """SELECT CAST(l_discount AS VARCHAR) AS v, false AS truncated FROM lineitem
WHERE l_discount IS NOT NULL GROUP BY 1""")
def _(spark, d):
    return grid.filter_values(tables.table(spark, d, "lineitem"), "l_discount")


@query("grid_value_filter", m.with_(m.DATA) + """SELECT * FROM data
WHERE (type_name IN ('1-URGENT', '5-LOW') OR type_name IS NULL) AND CAST(customer_id AS VARCHAR) IN ('1', '2', '3', '40')""")
def _(spark, d):
    return grid.value_filters(_data(spark, d), {
        "type_name": (["1-URGENT", "5-LOW"], True), "customer_id": (["1", "2", "3", "40"], False), "status": None,
    })


@query("view_search", m.with_(m.DATA) + """SELECT * FROM data
WHERE contains(lower(concat_ws(chr(10), id, customer_id, status, created_at, entry_date, name, type_name, segment,
  sales_channel_name, amount, recreated_order)), '-07-1')""")
def _(spark, d):
    return grid.view_search(_data(spark, d), "-07-1")


@query("error_rows", m.with_(m.EVENTS) + """SELECT user_id, event_type, event_time, status, lower(status) = 'error' AS is_error
FROM metric_events""")
def _(spark, d):
    return grid.flag_errors(_events(spark, d)).select("user_id", "event_type", "event_time", "status", "is_error")


@query("grid_page", m.with_(m.DATA) + "SELECT * FROM data ORDER BY created_at DESC NULLS LAST, id LIMIT 100 OFFSET 300")
def _(spark, d):
    return grid.grid_page(_data(spark, d), tiebreak=["id"], page=3)


_KEYSET = m.with_(m.DATA, "ends AS (SELECT created_at AS c, id AS i FROM data ORDER BY c DESC NULLS LAST, i LIMIT 1 OFFSET 299)")


def _held_row(data: DataFrame) -> DataFrame:
    """The row a reader is at: place 300 in page order, found by one top-n, not by a driver action."""
    first = grid.grid_sort(data.select("created_at", "id"), tiebreak=["id"]).limit(300)
    return grid.grid_sort(first, desc=False, tiebreak=["id"]).orderBy("created_at", F.desc("id")).limit(1)


@query("grid_page_keyset", _KEYSET + """SELECT data.* FROM data, ends WHERE created_at < c OR (created_at = c AND id > i)
ORDER BY created_at DESC NULLS LAST, id LIMIT 100""")
def _(spark, d):
    data = _data(spark, d)
    return grid.grid_page_after(data, None, True, "id", _held_row(data))


@query("grid_page_layout", _KEYSET + """SELECT data.* FROM data, ends WHERE created_at < c OR (created_at = c AND id > i)
ORDER BY created_at DESC NULLS LAST, id LIMIT 100""")
def _(spark, d):
    """The page behind place 300 from the two files that hold it, of a grid written in page order."""
    path, data = scratch(spark, "pages"), _data(spark, d)
    write_pages(data, path, "id", rows_per_file=1000)
    last = _held_row(data).first()
    return Pages(spark, path).after(last["created_at"], last["id"])


@query("grid_page_back", _KEYSET + """SELECT data.* FROM data, ends WHERE (created_at > c OR (created_at = c AND id < i)) AND status = 'O'
ORDER BY created_at, id DESC LIMIT 100""")
def _(spark, d):
    data = _data(spark, d)
    return grid.grid_window(data, "id", filters={"status": (["O"], False)}, before=_held_row(data))


@query("grid_count", m.with_(m.DATA) + "SELECT count(*) AS total FROM data WHERE lower(segment) LIKE '%build%' OR lower(name) LIKE '%build%'")
def _(spark, d):
    return grid.grid_count(grid.grid_search(_data(spark, d), "build"))


@query("grid_page_info", """SELECT count(*) AS total, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages,
  CAST(ceil(count(*) / 100.0) AS BIGINT) - 1 AS page FROM orders""")
def _(spark, d):
    return grid.page_info(_data(spark, d), page=10**9)


@query("filter_values", m.with_(m.DATA) + "SELECT DISTINCT CAST(entry_date AS VARCHAR) AS v, false AS truncated FROM data WHERE entry_date IS NOT NULL")
def _(spark, d):
    return grid.filter_values(_data(spark, d), "entry_date")


@query("filter_values_first", m.with_(m.DATA) + """SELECT v, true AS truncated FROM (
  SELECT DISTINCT CAST(entry_date AS VARCHAR) AS v FROM data) WHERE v > '1995-06-01' ORDER BY v LIMIT 50""")
def _(spark, d):
    return grid.filter_values(_data(spark, d), "entry_date", limit=50, after="1995-06-01")


@query("column_null_count", m.with_(m.DATA) + """SELECT count(*) FILTER (type_name IS NULL) AS type_name,
  count(*) FILTER (name IS NULL) AS name, count(*) FILTER (amount IS NULL) AS amount FROM data""")
def _(spark, d):
    return grid.column_null_count(_data(spark, d), ["type_name", "name", "amount"])


@query("view_sort", m.with_(m.DATA) + """SELECT id, CAST(customer_id AS VARCHAR) AS customer,
  CAST(row_number() OVER (ORDER BY customer_id, id) - 1 AS BIGINT) AS place FROM data""")
def _(spark, d):
    rows = _data(spark, d).select("id", F.col("customer_id").cast("string").alias("customer"))
    ordered = grid.view_sort(rows, "customer", tiebreak=["id"], numeric=True)
    return grid.with_place(ordered)


@query("table_preview", m.with_(m.DATA) + "SELECT * FROM data ORDER BY id LIMIT 100")
def _(spark, d):
    return grid.preview(_data(spark, d).orderBy("id"))


@query("csv_lines", m.with_(m.DATA) + """SELECT concat_ws(';', id, status, strftime(created_at, '%Y-%m-%d %H:%M:%S'), name,
  coalesce(type_name, ''), chr(34) || segment || ', ' || chr(34) || chr(34) || sales_channel_name || repeat(chr(34), 3),
  CAST(id * 100000000 AS BIGINT), CASE recreated_order WHEN 1 THEN '0.00025' ELSE '0' END, (recreated_order + 2) || '.5')
  AS value FROM data""")
def _(spark, d):
    rows = project(_data(spark, d), {
        "id": F.col("id"), "status": F.col("status"), "created_at": F.col("created_at"), "name": F.col("name"),
        "type_name": F.col("type_name"),
        "place": F.concat(F.col("segment"), F.lit(', "'), F.col("sales_channel_name"), F.lit('"')),
        "large": F.col("id") * 1e8, "small": F.col("recreated_order") * 0.00025,
        "short": (F.col("recreated_order") + 2.5).cast("float"),
    })
    return csv_lines(rows)


@query("numeric_columns", m.with_(m.DATA) + """SELECT * FROM (VALUES ('id', true), ('name', false), ('type_name', false), ('amount', true),
  ('phone', (SELECT regexp_full_match(min_by(CAST(customer_id AS VARCHAR), id), '-?[0-9]+([.][0-9]+)?') FROM data)))
  AS t(column_name, is_numeric)""")
def _(spark, d):
    rows = _data(spark, d).select("id", "name", "type_name", "amount", F.col("customer_id").cast("string").alias("phone"))
    return numeric_columns(rows, ["id"])


# --- sketches and search index ---------------------------------------------------------------

_SKETCHED = ("customer_id", "status", "type_name", "name", "amount")


def _sketched(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "sketched")
    write_snapshot(_data(spark, d), path, sketch=("entry_date", _SKETCHED))
    return read_sketches(spark, path)


@query("distinct_by_day", m.with_(m.DATA) + "\nUNION ALL ".join(
    f"SELECT entry_date AS day, '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values FROM data GROUP BY 1" for c in _SKETCHED))
def _(spark, d):
    return sketches.distinct_by_day(_sketched(spark, d))


@query("distinct_merged", m.with_(m.DATA) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS exact, "
    "true AS within_bound FROM data WHERE entry_date BETWEEN '1994-03-01' AND '1997-10-31'" for c in _SKETCHED))
def _(spark, d):
    """Months united from their days' sketches, held against the exact counts."""
    first, last = "1994-03-01", "1997-10-31"
    united = sketches.distinct_between(_sketched(spark, d), first, last)
    rows = _data(spark, d).where(F.col("entry_date").between(first, last)).select(*_SKETCHED)
    exact = column_profile(rows).select(F.col("column_name").alias("of"), F.col("distinct_values").alias("exact"))
    within = F.abs(F.col("distinct_values") - F.col("exact")) <= F.ceil(F.col("exact") * sketches.error_bound())
    return united.join(exact, F.col("column_name") == F.col("of")).select("column_name", "row_count", "nulls", "exact", within.alias("within_bound"))


@query("grid_search_indexed", m.with_(m.DATA) + "SELECT * FROM data WHERE " + " OR ".join(
    f"CAST({c} AS VARCHAR) ILIKE '%er#0000_0017%'" for c in ("status", "entry_date", "name", "type_name", "segment", "sales_channel_name")))
def _(spark, d):
    """The data in files by customer; the term's longest literal leaves out those that cannot hold it."""
    path = scratch(spark, "indexed")
    write_snapshot(_data(spark, d).repartitionByRange(8, "customer_id"), path, search_index=True)
    return search_snapshot(spark, path, "er#0000_0017")


# --- ad-hoc SQL ------------------------------------------------------------------------------

@query("adhoc_status_counts", m.with_(m.DATA) + "SELECT status, count(*) AS orders FROM data GROUP BY 1 ORDER BY orders DESC")
def _(spark, d):
    _data(spark, d).createOrReplaceTempView("data")
    return sql_.adhoc(spark, "SELECT status, count(*) AS orders\nFROM data\nGROUP BY 1\nORDER BY orders DESC;")


_PROFILE = "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS type, count(*) FILTER ({c} IS NULL) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values FROM data"
    for i, (c, t) in enumerate([
        ("id", "bigint"), ("customer_id", "bigint"), ("status", "string"), ("created_at", "timestamp_ntz"),
        ("entry_date", "string"), ("name", "string"), ("type_name", "string"), ("segment", "string"),
        ("sales_channel_name", "string"), ("amount", "decimal(18,2)"), ("recreated_order", "int")], 1))


@query("column_profile", m.with_(m.DATA) + _PROFILE)
def _(spark, d):
    return column_profile(_data(spark, d))


@query("saved_view", m.with_(m.DATA) + """SELECT segment, count(*) AS customers, CAST(sum(n) AS BIGINT) AS orders
FROM (SELECT segment, customer_id, count(*) AS n FROM data GROUP BY ALL) WHERE n > 5 GROUP BY 1""")
def _(spark, d):
    _data(spark, d).createOrReplaceTempView("data")
    sql_.saved_view(
        spark, "frequent_customers",
        "WITH c AS (SELECT segment, customer_id, count(*) AS n FROM data GROUP BY ALL) SELECT * FROM c WHERE n > 5",
    )
    return sql_.adhoc(spark, "SELECT segment, count(*) AS customers, sum(n) AS orders FROM frequent_customers GROUP BY 1")


@query("saved_view_refreshed", m.with_(m.DATA) + "SELECT status, count(*) AS orders FROM data WHERE recreated_order = 1 GROUP BY 1")
def _(spark, d):
    """The view is saved on a first snapshot; a second one replaces that before it is asked."""
    path = scratch(spark, "viewed")
    data = _data(spark, d)
    write_snapshot(data.where("recreated_order = 0"), path)
    snapshot_views(spark, path)
    sql_.saved_view(spark, "recreated", "SELECT * FROM data WHERE recreated_order = 1")
    write_snapshot(data, path)
    snapshot_views(spark, path)
    return sql_.adhoc(spark, "SELECT status, count(*) AS orders FROM recreated GROUP BY 1")


@query("quick_chart", m.with_(m.DATA) + "SELECT status AS label, count(*) AS value FROM data GROUP BY 1")
def _(spark, d):
    _data(spark, d).createOrReplaceTempView("data")
    result = sql_.adhoc(spark, "SELECT status, max(name) AS someone, count(*) AS orders, sum(amount) AS total FROM data GROUP BY 1")
    return sql_.quick_chart(result)


# --- streams -----------------------------------------------------------------------------------

_TIEBREAK = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _arriving(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table as a stream of several files and batches."""
    path = scratch(spark, name)
    df.repartition(4).write.parquet(path)
    return refresh.stream_table(spark, path, max_files=2)


@query("stream_latest_state", m.with_(m.DAY_LATEST) + "SELECT * FROM day_latest")
def _(spark, d):
    path = scratch(spark, "latest")
    stream = _arriving(spark, tables.table(spark, d, "lineitem"), "lines")
    refresh.refresh_latest(stream, path, ["l_orderkey"], ["l_shipdate"], _TIEBREAK, compact_every=2).awaitTermination()
    return refresh.read_latest(spark, path, ["l_orderkey"], ["l_shipdate"], _TIEBREAK)


@query("stream_latest_keys", m.with_(m.DAY_LATEST) + "SELECT * FROM day_latest WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(spark, d):
    """Some keys of the streamed table, from their buckets alone."""
    path = scratch(spark, "latest")
    stream = _arriving(spark, tables.table(spark, d, "lineitem"), "lines")
    refresh.refresh_latest(stream, path, ["l_orderkey"], ["l_shipdate"], _TIEBREAK, compact_every=2).awaitTermination()
    urgent = tables.table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return refresh.read_keys(spark, path, urgent, ["l_orderkey"], ["l_shipdate"], _TIEBREAK)


@query("stream_metric_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS cnt FROM events GROUP BY 1, 2")
def _(spark, d):
    path = scratch(spark, "counts")
    stream = _arriving(spark, tables.table(spark, d, "events").select("ts", "event_type"), "events")
    refresh.refresh_counts(stream, path, "ts", ["event_type"], compact_every=2).awaitTermination()
    return refresh.read_counts(spark, path, ["event_type"])
