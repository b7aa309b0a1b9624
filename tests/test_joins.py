import random

import pytest
from pyspark.sql import functions as F

from snapline.operators.joins import anti_not_in, decode, left_by_key, semi_window, spread_join
from snapline.operators.latest import latest_by
from snapline.operators.pushdown import (
    distinct_ids, key_stats, restrict_to_keys, restrict_to_range,
)


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


@pytest.mark.parametrize("ids, restricted, expected", [
    ([1], False, [2, 3]),
    ([1, None], False, [2, 3]),
    ([], False, [None, 1, 2, 3]),
    ([None], False, [None, 1, 2, 3]),
    ([99], False, [1, 2, 3]),
    # Restricted to the driver's keys, a set without any of them is an empty one.
    ([99], True, [None, 1, 2, 3]),
    ([99, 1], True, [2, 3]),
])
def test_not_in(spark, ids, restricted, expected):
    df = _ids(spark, [1, 2, 3, None])
    kept = anti_not_in(df, "id", _ids(spark, ids), "id", restricted)
    assert sorted((r.id for r in kept.collect()), key=lambda v: (v is not None, v)) == expected


def test_not_in_against_sql(spark):
    rng = random.Random(3)
    df = _ids(spark, [rng.choice([None, *range(30)]) for _ in range(200)])
    ids = _ids(spark, [rng.randrange(40) for _ in range(25)])
    df.createOrReplaceTempView("t"), ids.createOrReplaceTempView("i")
    expected = spark.sql("SELECT * FROM t WHERE id NOT IN (SELECT id FROM i)")
    kept = anti_not_in(df, "id", ids, "id")
    assert sorted(r.id for r in kept.collect()) == sorted(r.id for r in expected.collect())


@pytest.mark.parametrize("seed", range(4))
def test_semi_window_against_brute_force(spark, seed):
    rng = random.Random(seed)
    width = rng.choice([1, 2, 5])

    def sample(n, name):
        values = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(-40, 400)])) for i in range(n)]
        df = spark.createDataFrame(values, f"{name}_id int, k bigint, h int")
        moment = F.lit("2024-05-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h"))
        return values, df.withColumn(name, moment)

    rows, df = sample(150, "ts")
    anchors, anchor = sample(12, "start")
    expected = sorted(
        i for i, k, h in rows
        if h is not None and any(k is not None and k == k2 and s is not None and s <= h <= s + 24 * width for _, k2, s in anchors)
    )
    kept = semi_window(df, anchor, "k", "ts", "start", f"{width} days")
    assert sorted(r.ts_id for r in kept.collect()) == expected
    assert kept.columns == df.columns


def test_window_bounds_are_inclusive(spark):
    df = spark.sql("SELECT 1L AS k, explode(array(timestamp_ntz'2024-05-01 09:59:59', timestamp_ntz'2024-05-01 10:00:00',"
                   " timestamp_ntz'2024-05-02 10:00:00', timestamp_ntz'2024-05-02 10:00:01')) AS ts")
    anchor = spark.sql("SELECT 1L AS k, timestamp_ntz'2024-05-01 10:00:00' AS start")
    kept = semi_window(df, anchor, "k", "ts", "start", "1 day")
    assert sorted(str(r.ts) for r in kept.collect()) == ["2024-05-01 10:00:00", "2024-05-02 10:00:00"]


@pytest.mark.parametrize("split", [False, True])
def test_left_by_key_fans_out_and_keeps_unmatched(spark, rows, split):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (None, "r")], "rk bigint, y string")
    assert rows(left_by_key(left, right, "k", "rk", split)) == [(None, "c", None), (1, "a", "p"), (1, "a", "q"), (2, "b", None)]


def test_spread_join_refuses_keys_of_different_type(spark):
    with pytest.raises(TypeError):
        spread_join(spark.range(1), spark.sql("SELECT 1 AS k"), [("id", "k")], "left")


def test_latest_by_null_order_and_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, None, 1), (1, None, 2), (2, 5, 1), (2, 5, 3), (2, 4, 9), (3, None, 1), (3, 1, 0)], "id int, at int, n int"
    )
    assert rows(latest_by(df, ["id"], ["at"], ["n"])) == [(1, None, 2), (2, 5, 3), (3, 1, 0)]


def test_decode_keeps_rows_without_a_name(spark, rows):
    df = spark.createDataFrame([(1.0, 2.0), (9.0, None)], "a double, b double")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    named = decode(df, [("a", dim, "id", "name", "a_name"), ("b", dim, "id", "name", "b_name")])
    assert rows(named) == [(1.0, 2.0, "one", "two"), (9.0, None, None, None)]


def test_restrict_to_keys(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "b"), (2.0, "c"), (None, "d")], "id double, x string")
    driver = spark.createDataFrame([(1,), (1,), (None,), (7,)], "k bigint")
    assert sorted(r.x for r in restrict_to_keys(df, "id", driver, "k").collect()) == ["a", "b"]
    assert restrict_to_keys(df, "id", driver.limit(0), "k").isEmpty()


def test_restrict_to_range(spark):
    df, driver = spark.range(10), spark.createDataFrame([(3,), (6,), (None,)], "k bigint")
    assert [r.id for r in restrict_to_range(df, "id", driver, "k").collect()] == [3, 4, 5, 6]
    assert restrict_to_range(df, "id", driver.limit(0), "k").isEmpty()


def test_key_stats_and_distinct_ids(spark, rows):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (None,)], "k double")
    assert tuple(key_stats(df, ["k"]).first()) == (2, 1.0, 4.0)
    assert rows(distinct_ids(df, "k")) == [(1,), (4,)]


def test_bucket_predicates_cover_each_key_once():
    from snapline.sources.readers import key_buckets

    tests = key_buckets("id", 4)
    assert len(tests) == 5 and tests[0] == "MOD(id, 4) = 0" and tests[-1] == "id IS NULL"
    import duckdb

    parts = " UNION ALL ".join(f"SELECT id FROM t WHERE {t}" for t in tests)
    got = duckdb.sql(f"WITH t AS (SELECT unnest([-9, -4, -1, 0, 1, 2, 3, 7, 8, NULL]) AS id) SELECT id FROM ({parts}) ORDER BY id").fetchall()
    assert [r[0] for r in got] == [-9, -4, -1, 0, 1, 2, 3, 7, 8, None]
