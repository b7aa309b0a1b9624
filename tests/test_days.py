import pytest
from pyspark.sql import functions as F

from snapline.plans import days as D
from snapline.plans.snapshot import ContractError, Rules

SCHEMA = "id long, day string, v string"


def _df(spark, changed=()):
    rows = [(i, None if i % 11 == 0 else f"2024-01-{i % 9 + 1:02d}", f"v{i}") for i in range(100)]
    rows = [(i, d, "new" if d in changed and i % 2 else v) for i, d, v in rows]
    return spark.createDataFrame(rows, SCHEMA)


def _folders(path):
    return sorted(f"{p.parent.name}/{p.name}" for p in (path / "versions").glob("*/part_day=*"))


def test_a_second_build_writes_only_changed_days(spark, tmp_path, rows):
    path = str(tmp_path)
    first = D.write_days(_df(spark), path, "day")
    assert len(first["written"]) == 10 and first["row_count"] == 100
    again = D.write_days(_df(spark).repartition(7, "v"), path, "day")
    assert again["written"] == [] and rows(D.read_days(spark, path)) == rows(_df(spark))
    assert not list((tmp_path / "versions" / again["version"]).glob("part_day=*"))
    changed = _df(spark, {"2024-01-03", "2024-01-07"}).where("day is null or day <> '2024-01-09'")
    third = D.write_days(changed.unionByName(spark.createDataFrame([(7, "2024-02-01", "x")], SCHEMA)), path, "day")
    assert third["written"] == ["2024-01-03", "2024-01-07", "2024-02-01"] and "2024-01-09" not in third["parts"]
    full = str(tmp_path / "full")
    D.write_days(changed.unionByName(spark.createDataFrame([(7, "2024-02-01", "x")], SCHEMA)), full, "day")
    assert rows(D.read_days(spark, path)) == rows(D.read_days(spark, full))
    # Older versions stay readable as they were.
    assert rows(D.read_days(spark, path, version=first["version"])) == rows(_df(spark))
    # Rows without a day are a partition like any other.
    odd = D.write_days(_df(spark).withColumn("v", F.when(F.col("day").isNull(), "w").otherwise(F.col("v"))), path, "day")
    assert D.NO_DAY in odd["written"] and D.read_days(spark, path).where("day is null and v = 'w'").count() == 10


def test_a_period_opens_its_days_only(spark, tmp_path):
    path = str(tmp_path)
    D.write_days(_df(spark), path, "day")
    some = D.read_days(spark, path, "2024-01-04", "2024-01-05")
    assert {f.split("/")[-2] for f in some.inputFiles()} == {"part_day=2024-01-04", "part_day=2024-01-05"}
    assert some.count() == _df(spark).where("day between '2024-01-04' and '2024-01-05'").count()
    assert D.read_days(spark, path, "2025-01-01").count() == 0 and D.read_days(spark, path).columns == ["id", "day", "v"]


def test_pruning_counts_references(spark, tmp_path, rows):
    path = str(tmp_path)
    made = [D.write_days(_df(spark, set(days)), path, "day") for days in ((), ("2024-01-01",), ("2024-01-01", "2024-01-02"))]
    gone = D.prune_days(spark, path, keep=1)
    # The first version wrote eight days that the last one still refers to; of the two that changed one is left to nobody.
    assert f"{made[0]['version']}/part_day=2024-01-01" in gone and f"{made[0]['version']}/part_day=2024-01-02" in gone
    assert rows(D.read_days(spark, path)) == rows(_df(spark, {"2024-01-01", "2024-01-02"}))
    assert len(_folders(tmp_path)) == 10
    assert D.prune_days(spark, path, keep=1) == [] and D.read_pointer(spark, path)["published"] == [made[2]["version"]]
    D.write_days(_df(spark), path, "day")
    assert rows(D.read_days(spark, path)) == rows(_df(spark))


def test_failures_leave_the_current_version(spark, tmp_path, rows):
    path = str(tmp_path)
    D.write_days(_df(spark), path, "day")
    before = _folders(tmp_path)
    with pytest.raises(ContractError):
        D.write_days(_df(spark).withColumn("day", F.lit("yesterday")), path, "day")
    with pytest.raises(ContractError):
        D.write_days(_df(spark).where("id < 5"), path, "day", Rules(min_rows=50))
    with pytest.raises(ContractError):
        D.write_days(_df(spark), path, "day", Rules(("absent",)))
    assert _folders(tmp_path) == before and rows(D.read_days(spark, path)) == rows(_df(spark))


def test_other_columns_are_a_new_history(spark, tmp_path):
    path = str(tmp_path)
    D.write_days(_df(spark), path, "day")
    wider = D.write_days(_df(spark).withColumn("more", F.lit(1)), path, "day")
    assert len(wider["written"]) == 10 and D.read_days(spark, path).columns == ["id", "day", "v", "more"]
    assert D.write_days(_df(spark).where("false").withColumn("more", F.lit(1)), path, "day")["parts"] == {}
    assert D.read_days(spark, path).count() == 0
    with pytest.raises(ValueError):
        D.read_days(spark, f"{path}/nothing")


def test_months_are_parts_where_days_are_small(spark, tmp_path, rows):
    path = str(tmp_path)
    df = spark.range(300).selectExpr("id", "date'2024-01-01' + cast(id AS int) AS day", "'x' AS v")
    assert len(D.write_days(df, path, "day", grain="month")["written"]) == 10
    changed = df.withColumn("v", F.when(F.col("day") == "2024-03-05", "y").otherwise(F.col("v")))
    assert D.write_days(changed, path, "day", grain="month")["written"] == ["2024-03"]
    some = D.read_days(spark, path, "2024-02-10", "2024-03-05")
    assert rows(some) == rows(changed.where("day between '2024-02-10' and '2024-03-05'")) and len({f.split("/")[-2] for f in some.inputFiles()}) == 2
    assert len(D.write_days(df, path, "day")["written"]) == 300
