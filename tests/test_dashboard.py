import random

from pyspark.sql import functions as F

from snapline.catalog.analysis import ORDER_DASHBOARD
from snapline.operators import dashboard as dash
from snapline.operators.dashboard import Panels, bar, dashboard, equality_filters, filter_options, kpis, line
from snapline.sources import tables
from tests.conftest import SMALL


def _data(spark):
    return spark.createDataFrame(
        [(1, "a", "d1", 5, True), (2, "a", "d2", None, True), (3, "b", "d1", 7, False), (4, None, "d3", 1, False)],
        "id int, s string, d string, v int, flag boolean",
    )


SPECS = [
    {"agg": "count", "field": "v"}, {"agg": "count_distinct", "field": "s"}, {"agg": "sum", "field": "v"},
    {"agg": "avg", "field": "v"}, {"agg": "median", "field": "v"},
]


def test_kpis(spark):
    df = kpis(_data(spark), SPECS)
    assert tuple(df.first()) == (3.0, 2.0, 13.0, 13 / 3, 13.0)
    assert {t for _, t in df.dtypes} == {"double"}


def test_approximate_kpis_need_no_expansion(spark):
    df = kpis(_data(spark), SPECS, approximate=True)
    assert df.first()[1] == 2.0
    assert "Expand" not in df._jdf.queryExecution().toString()


def test_kpis_of_nothing_are_zero(spark):
    assert tuple(kpis(_data(spark), SPECS, {"s": "zzz"}).first()) == (0.0,) * 5


def test_equality_filters(spark):
    df = _data(spark)
    assert equality_filters(df, {"s": "__all__", "d": "", "id": None}).count() == 4
    assert equality_filters(df, {"s": "a", "id": "2"}).count() == 1
    assert equality_filters(df, {"flag": "true"}).count() == 2


def test_bar_orders_and_limits(spark):
    assert [tuple(r) for r in bar(_data(spark), "s", "id", "count").collect()] == [("a", 2.0), ("b", 1.0), (None, 1.0)]
    assert [r.x for r in bar(_data(spark), "s", "id", "count", limit=1).collect()] == ["a"]


def test_bar_puts_null_totals_last(spark):
    df = spark.createDataFrame([("a", None), ("b", -1)], "x string, v int")
    assert [tuple(r) for r in bar(df, "x", "v", "sum").collect()] == [("b", -1.0), ("a", None)]


def test_line_without_series(spark):
    assert [tuple(r) for r in line(_data(spark), "d", "id", "count").collect()] == [
        ("d1", "all", 2.0), ("d2", "all", 1.0), ("d3", "all", 1.0)
    ]


def test_dense_line_fills_holes_and_null_totals_over_observed_days(spark, rows):
    dense = line(_data(spark), "d", "v", "sum", series="s", dense=True)
    assert [tuple(r) for r in dense.collect()] == [
        ("d1", "a", 5.0), ("d1", "b", 7.0), ("d1", None, 0.0),
        ("d2", "a", 0.0), ("d2", "b", 0.0), ("d2", None, 0.0),
        ("d3", "a", 0.0), ("d3", "b", 0.0), ("d3", None, 1.0),
    ]


def test_filter_options(spark):
    assert [r.s for r in filter_options(_data(spark), "s").collect()] == ["a", "b"]


def test_whole_dashboard_from_a_spec(spark):
    spec = {
        "filters": [{"field": "s"}],
        "kpis": SPECS[:1],
        "widgets": [{"type": "line", "x": "d", "y": "id", "agg": "count"}, {"type": "bar", "x": "s", "y": "id", "agg": "count", "limit": 2}],
    }
    frames = dashboard(_data(spark), spec, {"d": "d1"})
    assert frames["kpis"].first()[0] == 2.0
    assert [df.count() for df in frames["widgets"]] == [1, 2]
    assert frames["filters"]["s"].count() == 2


def test_lines_of_a_dashboard_are_zero_filled(spark):
    df = spark.createDataFrame([("d1", "a", 1), ("d2", "a", None), ("d3", "b", 2), (None, None, 3)], "d string, s string, v int")
    spec = {"widgets": [{"type": "line", "x": "d", "y": "v", "agg": "sum", "series": "s"}, {"type": "line", "x": "d", "y": "v", "agg": "sum"}]}
    several, single = dashboard(df, spec)["widgets"]
    got = {(r.x, r.s): r.y for r in several.collect()}
    assert len(got) == 4 * 3 and got["d1", "a"] == 1 and got["d2", "a"] == 0 and got["d2", "b"] == 0 and got[None, None] == 3
    assert {(r.x, r.y) for r in single.collect()} == {("d1", 1.0), ("d2", 0.0), ("d3", 2.0), (None, 3.0)}


def test_sums_of_large_integers_do_not_overflow(spark):
    df = spark.range(4).selectExpr("9223372036854775807L AS `a.b`")
    assert kpis(df, [{"agg": "sum", "field": "a.b"}]).first()[0] == 4 * (2.0**63)


ALL_KINDS = {
    "filters": [{"field": "s"}, {"field": "flag"}, {"field": "set"}],
    "kpis": [*SPECS, {"agg": "count_distinct", "field": "v"}, {"agg": "count_distinct", "field": "rows"}],
    "widgets": [
        {"type": "bar", "x": "s", "y": "v", "agg": "sum"}, {"type": "bar", "x": "rows", "y": "v", "agg": "avg", "limit": 2},
        {"type": "bar", "x": "d", "y": "s", "agg": "count_distinct"}, {"type": "line", "x": "set", "y": "d", "agg": "count"},
        {"type": "line", "x": "s", "y": "s", "agg": "count_distinct", "series": "flag"},
        {"type": "line", "x": "s", "y": "v", "agg": "sum", "series": "s"},
    ],
}


def test_panels_of_one_scan_equal_single_panels(spark):
    """Every kind of panel, with columns named as the groups' own and NULL in every column."""
    drawn = random.Random(3)
    some = lambda *values: drawn.choice([None, *values])
    rows = [(i, some("a", "b", "c"), some("d1", "d2"), some(1, 2, 7), some(True, False), some(4, 5), some("x", "y")) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, s string, d string, v int, flag boolean, rows long, `set` string")
    for filters, approximate in ((None, True), ({"s": "a", "flag": "true", "d": ""}, False)):
        frames = dashboard(df, ALL_KINDS, filters, approximate)
        assert frames["kpis"].collect() == kpis(df, ALL_KINDS["kpis"], filters, approximate).collect()
        for name, found in frames["filters"].items():
            assert found.collect() == filter_options(df, name).collect()
        for widget, found in zip(ALL_KINDS["widgets"], frames["widgets"]):
            w = dict(widget)
            if w.pop("type") == "bar":
                want = bar(df, w["x"], w["y"], w["agg"], w.get("limit"), filters, approximate)
            else:
                want = line(df, w["x"], w["y"], w["agg"], w.get("series"), filters, True, approximate)
            assert found.columns == want.columns and found.collect() == want.collect(), (widget, filters)


def test_dashboards_of_little(spark):
    df = _data(spark)
    assert dashboard(df, {}) == {"filters": {}, "kpis": None, "widgets": []}
    assert dashboard(df, {"kpis": SPECS[2:3]}, {"s": "a"})["kpis"].first()[0] == 5.0
    empty = dashboard(df.where("false"), {"kpis": SPECS, "widgets": [{"type": "bar", "x": "s", "y": "v", "agg": "sum"}]})
    assert tuple(empty["kpis"].first()) == (0.0,) * 5 and empty["widgets"][0].count() == 0


def test_a_dashboard_reads_its_rows_once(spark):
    data = tables.table(spark, SMALL, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("sales_channel_name"), F.col("o_orderdate").alias("entry_date"), F.lit(1).alias("recreated_order"),
    )
    plan = Panels(data, ORDER_DASHBOARD, {"status": "O"}).table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    frames = dashboard(data, ORDER_DASHBOARD, {"status": "O"})
    for df in (frames["kpis"], *frames["filters"].values(), *frames["widgets"]):
        assert all("/panels-" in name for name in df.inputFiles())


def test_a_long_axis_is_never_one_row(spark, monkeypatch):
    monkeypatch.setattr(dash, "AXIS_BLOCK", 100)
    points = spark.range(5000).selectExpr("id AS x", "if(id % 2 = 0, 'a', null) AS s", "1.0D AS y")
    full = dash.densify(points)
    assert full.count() == 10_000 and full.agg(F.sum("y")).first()[0] == 5000 and full.distinct().count() == 10_000
    assert dash.densify(points.where("false")).count() == 0
    text = full._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
