import pytest
from pyspark.sql import functions as F

from snapline.operators.metrics import metric_counts, normalize_metrics, sample_series, union_all


def test_metric_counts_filter_source_columns_before_the_swap(spark, rows):
    events = spark.createDataFrame(
        [("A", "open", "d1"), ("A", "open", "d1"), ("A", "", "d1"), ("A", None, "d1"), ("B", "open", "d1"), ("B", "x", "d2")],
        "metrics string, event_type string, entry_date string",
    )
    counts = metric_counts(events, F.col("metrics"), "event_type", F.col("entry_date"), F.col("metrics") == "A")
    assert rows(counts) == [("A", "open", "d1", 2)]
    fixed = metric_counts(events, F.lit("L"), "event_type", F.left("entry_date", F.lit(1)))
    assert rows(fixed) == [("L", "open", "d", 3), ("L", "x", "d", 1)]


def test_union_is_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2.0)], "t string, d double")
    both = union_all([a, b])
    assert both.columns == ["n", "t", "d"]
    assert rows(both) == [(None, "y", 2.0), (1, "x", None)]
    with pytest.raises(ValueError):
        union_all([])


def test_normalize(spark):
    df = spark.createDataFrame([(1, "12.9"), (None, "bad"), (2, None)], "platform int, cnt string")
    out = normalize_metrics(df)
    assert out.dtypes == [("platform", "string"), ("cnt", "bigint")]
    assert [tuple(r) for r in out.collect()] == [("1", 12), (None, 0), ("2", 0)]
    other = spark.range(1)
    assert normalize_metrics(other).columns == ["id"]


def test_sample_series(spark):
    catalogue = spark.createDataFrame([("P", f"m{i}", i * 37) for i in range(11)], "platform string, metrics string, seed int")
    series = sample_series(catalogue, "2024-03-01", 60)
    rows = series.collect()
    assert series.columns == ["platform", "metrics", "entry_date", "cnt"] and len(rows) == 660
    assert {r.entry_date for r in rows} >= {"2024-03-01", "2024-01-02"} and len({r.entry_date for r in rows}) == 60
    assert all(40 <= r.cnt <= 5000 * 1.5 + 1000 for r in rows) and len({r.cnt for r in rows}) > 500
    assert sample_series(catalogue, "2024-03-01", 60).collect() == rows
