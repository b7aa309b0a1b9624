import pytest
from pyspark.sql import functions as F

from snapline.operators.latest import latest_by
from snapline.streaming import refresh

KEYS, ORDER, TIE = ["k"], ["at"], ["n"]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "in" / "rows.parquet")
    df = spark.range(600).selectExpr(
        "id % 40 AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int((id * 7919) % 240)) AS at", "id AS n",
        "string(id % 3) AS kind",
    )
    df.repartition(6).write.parquet(path)
    return path


def _batches(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_latest_over_batches_is_the_batch_result(spark, tmp_path, table, rows):
    path = str(tmp_path / "latest")
    expected = rows(latest_by(spark.read.parquet(table), KEYS, ORDER, TIE))
    refresh.refresh_latest(_batches(spark, table), path, KEYS, ORDER, TIE).awaitTermination()
    assert len(list((tmp_path / "latest" / "changes").glob("batch_id=*"))) == 6
    assert rows(refresh.read_latest(spark, path, KEYS, ORDER, TIE)) == expected

    refresh.compact(spark, path, KEYS, ORDER, TIE)
    assert rows(refresh.read_latest(spark, path, KEYS, ORDER, TIE)) == expected

    late = spark.sql("SELECT 3L AS k, timestamp_ntz'2025-01-01 00:00:00' AS at, 1L AS n, 'z' AS kind")
    late.write.mode("append").parquet(table)
    refresh.refresh_latest(_batches(spark, table), path, KEYS, ORDER, TIE).awaitTermination()
    assert rows(refresh.read_latest(spark, path, KEYS, ORDER, TIE)) == rows(
        latest_by(spark.read.parquet(table), KEYS, ORDER, TIE)
    )


def test_compacting_on_the_way_changes_nothing_and_bounds_the_files(spark, tmp_path, table, rows):
    path = str(tmp_path / "latest")
    expected = rows(latest_by(spark.read.parquet(table), KEYS, ORDER, TIE))
    refresh.refresh_latest(_batches(spark, table), path, KEYS, ORDER, TIE, compact_every=2).awaitTermination()
    assert rows(refresh.read_latest(spark, path, KEYS, ORDER, TIE)) == expected
    assert len(list((tmp_path / "latest" / "changes").glob("batch_id=*"))) == 2
    assert len(list((tmp_path / "latest" / "base").iterdir())) == 2
    # The last batch once more, as after a failure between its write and its commit.
    change = spark.read.parquet(f"{path}/changes/batch_id=5")
    change.cache().count()
    refresh._write_change(change, path, 5)
    refresh.compact(spark, path, KEYS, ORDER, TIE)
    assert rows(refresh.read_latest(spark, path, KEYS, ORDER, TIE)) == expected


def test_replayed_batch_counts_once(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "a")], "k int, v string")
    for _ in range(2):
        refresh._write_change(batch, path, 0)
    assert rows(refresh.read_latest(spark, path, ["k"], ["v"])) == [(1, "a")]


def test_counts_over_batches_are_the_batch_result(spark, tmp_path, table, rows):
    path = str(tmp_path / "counts")
    refresh.refresh_counts(_batches(spark, table), path, "at", ["kind"]).awaitTermination()
    expected = spark.read.parquet(table).groupBy(F.to_date("at").alias("day"), "kind").agg(F.count("*").alias("cnt"))
    assert rows(refresh.read_counts(spark, path, ["kind"])) == rows(expected)
    refresh.compact(spark, path, ["day", "kind"], ["batch_id"])
    assert rows(refresh.read_counts(spark, path, ["kind"])) == rows(expected)


def test_counts_with_a_watermark(spark, tmp_path, table, rows, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    path = str(tmp_path / "counts")
    stream = refresh.stream_table(spark, table)
    refresh.refresh_counts(stream, path, "at", ["kind"], watermark="20 days").awaitTermination()
    expected = spark.read.parquet(table).groupBy(F.to_date("at").alias("day"), "kind").agg(F.count("*").alias("cnt"))
    assert rows(refresh.read_counts(spark, path, ["kind"])) == rows(expected)


def test_nothing_written_yet(spark, tmp_path):
    with pytest.raises(ValueError):
        refresh.read_latest(spark, str(tmp_path), KEYS, ORDER)


def _files(folder):
    return {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_compaction_rewrites_only_the_buckets_that_changes_touch(spark, tmp_path, rows):
    path, folder = str(tmp_path / "t"), tmp_path / "t" / "base"
    first = spark.range(400).selectExpr("id AS k", "0L AS at", "id AS bucket", "id AS key_bucket_")
    refresh._write_change(first, path, 0)
    refresh.compact(spark, path, ["k"], ["at"], buckets=32)
    before = _files(folder)
    assert len({name.parts[1] for name in before}) == 32
    changed = spark.createDataFrame([(7, 1, -1, -1), (9, 1, -1, -1), (1000, 1, -1, -1), (11, -1, -1, -1)], first.schema)
    refresh._write_change(changed, path, 1)
    refresh.compact(spark, path, ["k"], ["at"], buckets=5)  # a table keeps the number it began with
    touched = {r[0] for r in changed.select(refresh.bucket_of(["k"], 32)).collect()}
    after = _files(folder)
    assert all(after[name] == stamp for name, stamp in before.items()) and 1 < len(touched) <= 4
    assert {name.parts[1] for name in set(after) - set(before)} == {f"key_bucket={b}" for b in touched}
    want = rows(latest_by(first.unionByName(changed), ["k"], ["at"]))
    assert rows(refresh.read_latest(spark, path, ["k"], ["at"])) == want
    # What the first compaction wrote of these buckets is still there for readers on the old pointer, and goes with the next.
    refresh._write_change(changed.limit(1), path, 2)
    refresh.compact(spark, path, ["k"], ["at"])
    last = _files(folder)
    gone = {name.parts[1] for name in set(after) - set(last)}
    assert gone == {f"key_bucket={b}" for b in touched}
    assert rows(refresh.read_latest(spark, path, ["k"], ["at"])) == want
    # A bucket's current files are one version: each bucket in use is listed once in the pointer.
    assert set(refresh._state(spark, path)["buckets"]) == {str(b) for b in range(32)}


def test_some_keys_read_only_their_buckets(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    refresh._write_change(spark.range(300).selectExpr("id AS k", "1L AS at"), path, 0)
    refresh.compact(spark, path, ["k"], ["at"])
    refresh._write_change(spark.createDataFrame([(5, 2), (500, 2)], "k long, at long"), path, 1)
    some = spark.createDataFrame([(5,), (6,), (500,), (501,)], "k long")
    found = refresh.read_keys(spark, path, some, ["k"], ["at"])
    assert rows(found) == [(5, 2), (500, 2), (6, 1)]
    assert len({f.split("/")[-2] for f in found.inputFiles() if "/base/" in f}) <= 4
    assert refresh.read_keys(spark, path, some.where("false"), ["k"], ["at"]).count() == 0
    refresh.compact(spark, path, ["k"], ["at"])
    assert rows(refresh.read_keys(spark, path, some, ["k"], ["at"])) == [(5, 2), (500, 2), (6, 1)]
