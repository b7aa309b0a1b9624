import pytest

from snapline.operators.adhoc import NotReadOnly, adhoc, quick_chart, saved_view


@pytest.fixture(autouse=True)
def data(spark):
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "status string, id int").createOrReplaceTempView("data")


def test_reads(spark):
    assert {tuple(r) for r in adhoc(spark, "SELECT status, count(*) FROM data GROUP BY 1 ;; ").collect()} == {("a", 2), ("b", 1)}
    assert adhoc(spark, "with a as (select 1 x) select * from a").first().x == 1
    assert adhoc(spark, "describe data").count() == 2
    assert adhoc(spark, "SHOW VIEWS").count() >= 1
    assert adhoc(spark, "SELECT 'reflect(1)' AS t").first().t == "reflect(1)"


@pytest.mark.parametrize("sql", [
    "drop table v", "with a as (select 1 x) insert into t select * from a", "select 1; select 2", "",
    "insert into t values (1)", "create table t as select 1", "set spark.x=1", "pragma version", "selec 1",
    "describe data; drop view data", "refresh table data", "explain select 1", "cache table data",
])
def test_refuses(spark, sql):
    with pytest.raises(NotReadOnly):
        adhoc(spark, sql)


def test_refuses_files_and_jvm_calls(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1).write.parquet(path)
    with pytest.raises(Exception):
        adhoc(spark, f"select * from parquet.`{path}`")
    assert spark.sql(f"select * from parquet.`{path}`").count() == 1
    for call in ("reflect", "java_method", "`reflect`", "try_reflect"):
        with pytest.raises(NotReadOnly):
            adhoc(spark, f"select {call}('java.lang.System', 'nanoTime')")
        with pytest.raises(NotReadOnly):
            adhoc(spark, f"select * from (select 1) where exists (select {call}('java.lang.System', 'nanoTime'))")


def test_saved_views_compose(spark):
    saved_view(spark, "many", "SELECT status, count(*) AS n FROM data GROUP BY 1")
    saved_view(spark, "most", "WITH m AS (SELECT * FROM many) SELECT status FROM m WHERE n > 1")
    assert [r.status for r in adhoc(spark, "SELECT * FROM most").collect()] == ["a"]
    with pytest.raises(NotReadOnly):
        saved_view(spark, "bad", "SHOW TABLES")


def test_quick_chart(spark):
    chart = quick_chart(adhoc(spark, "SELECT id, status, count(*) AS n FROM data GROUP BY 1, 2"))
    assert chart.columns == ["label", "value"] and {tuple(r) for r in chart.collect()} == {(1, 1), (2, 1), (3, 1)}
    assert quick_chart(adhoc(spark, "SELECT id, status FROM data")) is None


def test_a_saved_view_answers_from_the_newest_snapshot(spark, tmp_path):
    from snapline.plans.snapshot import snapshot_views, write_snapshot

    path = str(tmp_path / "s")
    write_snapshot(spark.range(3), path)
    snapshot_views(spark, path)
    saved_view(spark, "kept", "SELECT * FROM data WHERE id >= 0;")
    write_snapshot(spark.range(10), path)
    snapshot_views(spark, path)
    assert spark.table("kept").count() == 10
