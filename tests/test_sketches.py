import pytest
from pyspark.sql import functions as F

from snapline.operators import sketches as S
from snapline.plans.snapshot import ContractError, read_manifest, read_sketches, write_snapshot


def _rows(spark, n=60_000):
    return spark.range(n).selectExpr(
        "date_format(date'2024-01-01' + int(id % 30), 'yyyy-MM-dd') AS day", "id % 20011 AS v", "if(id % 3 = 0, null, string(id % 5000)) AS s",
        "cast(id % 7 AS decimal(9,2)) AS d", "cast(null AS int) AS nothing",
    )


def test_united_days_stay_within_the_bound(spark):
    df, columns = _rows(spark), ["v", "s", "d", "nothing"]
    made = S.day_sketches(df, "day", columns)
    assert made.count() == 30 * 4
    for first, last in ((None, None), ("2024-01-05", "2024-01-20"), ("2024-01-07", "2024-01-07"), ("2030-01-01", None)):
        kept = df.where(F.col("day").between(first or "0", last or "9"))
        found = {r.column_name: r for r in S.distinct_between(made, first, last).collect()}
        exact = kept.agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(c) for c in columns], *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]).first()
        if not exact.n:
            assert not found
            continue
        for c in columns:
            assert (found[c].row_count, found[c].nulls) == (exact.n, exact[f"{c}_nulls"])
            assert abs(found[c].distinct_values - exact[c]) <= S.error_bound() * exact[c]


def test_more_registers_have_a_smaller_bound(spark):
    assert S.error_bound(14) == pytest.approx(S.error_bound(12) / 2)
    df = _rows(spark)
    found = S.distinct_between(S.day_sketches(df, "day", ["v"], 14)).first()
    assert abs(found.distinct_values - 20011) <= S.error_bound(14) * 20011


def test_each_row_is_reduced_before_the_exchange(spark):
    plan = S.day_sketches(_rows(spark), "day", ["v", "s"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_hll_sketch_agg" in plan and "Expand" not in plan


def test_a_snapshot_keeps_its_sketches(spark, tmp_path):
    path = str(tmp_path / "s")
    df = _rows(spark, 3000)
    write_snapshot(df, path)
    with pytest.raises(ContractError):
        read_sketches(spark, path)
    write_snapshot(df, path, sketch=("day", ["v", "s", "absent"]))
    assert read_manifest(spark, path).sketches == {"day": "day", "columns": ["v", "s"]}
    by_day = S.distinct_by_day(read_sketches(spark, path))
    exact = df.groupBy("day").agg(F.count_distinct("v").alias("v")).join(by_day.where("column_name = 'v'"), "day")
    assert exact.count() == 30 and exact.where("v <> distinct_values").count() == 0
    assert all("/sketches/" in f for f in by_day.inputFiles())
