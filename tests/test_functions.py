import duckdb
from pyspark.sql import functions as F

from snapline.functions.dates import fmt_day, fmt_ts, instant_day, local_day_start, local_time, period_id, read_time, wall_instant
from snapline.functions.keys import is_number_text, key_of, safe_bigint, to_key, truncated_bigint
from snapline.functions.texts import text_of
from snapline.functions.predicates import has_text, not_like_any, whitelist


def test_double_key_rounds_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-1.5,), (1e30,), (float("nan"),), (None,), (-(2.0**63),), (2.0**63,)], "d double")
    assert [r[0] for r in df.select(to_key("d")).collect()] == [0, 2, 2, -2, None, None, None, -(2**63), None]


TEXTS = [
    "12.7", " 12 ", "1e3", "abc", "", "12.5", "-12.5", "0.5", "nan", "inf", "+5", "5.", ".5", "+.5", "-.5", "1e-1", "1E5",
    "0.5e1", "7\t", "\n7", "- 5", "1 2", "12e", "--1", "1,5", "0.49999999999999999", "007", "-0", "1e18", "1e19", "1e400",
    "9007199254740993", "9007199254740993.5", "9223372036854775807", "9223372036854775808", "-9223372036854775808",
    "9223372036854775807.4", "9223372036854775807.5", "-9223372036854775808.4", "99999999999999999999",
]


def test_text_to_bigint_is_the_sql_cast(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string")
    expected = [duckdb.execute("SELECT TRY_CAST(? AS BIGINT)", [t]).fetchall()[0][0] for t in TEXTS]
    assert [r[0] for r in df.select(safe_bigint("s")).collect()] == expected
    assert expected[:8] == [13, 12, 1000, None, None, 13, -13, 1]


def test_truncated_bigint(spark):
    df = spark.createDataFrame([("12.7",), ("-12.7",), ("x",), ("1e3",), (None,), ("1e400",), ("9223372036854775807",)], "s string")
    assert [r[0] for r in df.select(truncated_bigint("s")).collect()] == [12, -12, None, 1000, None, None, 2**63 - 1]


def test_key_of_follows_the_declared_type(spark):
    df = spark.createDataFrame([(2**53 + 1, 7.0, "8")], "a bigint, b double, c string")
    assert tuple(df.select(key_of(df, "a"), key_of(df, "b"), key_of(df, "c")).first()) == (2**53 + 1, 7, 8)


def test_local_time_uses_the_zone_history(spark):
    df = spark.createDataFrame([("2024-02-29 17:30",), ("2024-02-29 20:30",)], "s string").select(read_time("s").alias("t"))
    assert [str(r[0]) for r in df.select(local_time("t")).collect()] == ["2024-02-29 23:30:00", "2024-03-01 01:30:00"]


def test_local_day_start_is_the_same_test_as_comparing_dates(spark):
    df = spark.sql("""SELECT timestamp_ntz'2024-02-27 00:00:00' + make_dt_interval(0, 0, id * 7) AS t FROM range(900)""")
    for as_of in ("2024-02-29 18:59:59", "2024-02-29 19:00:00", "2024-03-01 18:30:00"):
        by_range = df.where(F.col("t") < local_day_start(as_of))
        by_date = df.where(F.to_date(local_time("t")) < F.to_date(local_time(F.lit(as_of))))
        assert by_range.exceptAll(by_date).isEmpty() and by_date.exceptAll(by_range).isEmpty()


def test_formats(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-05 06:07:08' AS t")
    assert tuple(df.select(period_id("t"), fmt_day("t"), fmt_ts("t")).first()) == (202403, "2024-03-05", "2024-03-05 06:07:08")


def test_unreadable_time_is_null(spark):
    df = spark.createDataFrame([("2024-03-05 06:07:08",), ("soon",), (None,)], "s string")
    assert [r[0] is None for r in df.select(read_time("s")).collect()] == [False, True, True]


def test_number_text(spark):
    df = spark.createDataFrame([("1",), ("-1.5",), ("1.",), ("1e3",), ("",)], "s string")
    assert [r[0] for r in df.select(is_number_text("s")).collect()] == [True, True, False, False, False]


def test_predicates(spark):
    df = spark.createDataFrame(
        [("A", "x"), ("B", "x"), ("B", "y"), ("C", "x"), ("A", ""), ("A", None), (None, "x")], "g string, e string"
    )
    kept = df.where(whitelist("g", "e", {"A": None, "B": ["y"]}))
    assert sorted((r.g, r.e or "") for r in kept.collect()) == [("A", ""), ("A", ""), ("A", "x"), ("B", "y")]
    assert df.where(has_text("e")).count() == 5


def test_like_wildcards_stay_wildcards(spark):
    df = spark.createDataFrame([("detail_promo_1",), ("detailXpromoY1",), ("other",)], "e string")
    assert [r[0] for r in df.where(not_like_any("e", ["detail_promo_%", "company_promo_%"])).collect()] == ["other"]


def test_times_do_not_depend_on_the_session_zone(spark, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.5' AS t")
    row = df.select(fmt_ts("t"), fmt_day("t"), period_id("t"), instant_day(wall_instant("t")), local_time("t")).first()
    assert [str(v) for v in row] == ["2024-03-10 02:30:00", "2024-03-10", "202403", "2024-03-10", "2024-03-10 07:30:00.500000"]
    early = spark.sql("SELECT timestamp_ntz'1969-12-31 23:00:00' AS t")
    assert str(early.select(instant_day(wall_instant("t"))).first()[0]) == "1969-12-31"


def test_double_text_is_the_sql_text(spark):
    numbers = [
        1e7, 12345678.9, 1e15, 9007199254740993.0, 1e16, 123456789012345678.0, 0.001, 0.0001, 0.00012345678901234567, 1e-5,
        1.5e-5, 0.0, 0.1, 1e22, 2.5e-300, 1.7976931348623157e308, -1e8, -1e-7, 999999.5, float("nan"), float("inf"), -float("inf"),
    ]
    df = spark.createDataFrame([(n,) for n in numbers] + [(None,)], "d double")
    expected = [duckdb.execute("SELECT CAST(? AS VARCHAR)", [n]).fetchall()[0][0] for n in numbers]
    assert [r[0] for r in df.select(text_of(df, "d")).collect()] == [*expected, None]
