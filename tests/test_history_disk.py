"""What the history build keeps on disk at once."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapline.plans import assemble as A
from snapline.plans import days as D
from snapline.session import passing_shuffles, scanned_bytes
from snapline.sources import tables

CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _at(minutes):
    return F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def _history(spark, tmp_path):
    """Sources in files: equal times, repeated rows, CRM orders without an id, customers without orders."""
    orders = spark.range(300).select(
        "id", F.when(F.col("id") % 17 > 0, F.col("id") % 40).alias("customer_id"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("crm_order_id"), F.lit("new").alias("status"),
        _at(F.col("id") * 7 % 4000).alias("created_at"),
    )
    n = F.col("n")
    texts = ("type_name", "status_name", "sales_channel_name", "username_created_order", "reject_reason_name", "new_product_offer_name")
    crm = spark.range(2000).select((F.col("id") % 1500).alias("n")).select(
        F.when(n % 19 > 0, n % 45).cast("double").alias("customer_id"),
        F.when(n % 23 > 0, _at(n * 11 % 3000 * 2)).alias("order_date_create"), _at(n).alias("order_close_date"),
        *[F.concat(F.lit(f"{name} "), n.cast("string")).alias(name) for name in texts],
        F.when(n % 13 > 0, n).cast("string").alias("cust_order_id"),
        (n % 3).cast("double").alias("new_product_offer_id"), (n % 2).cast("double").alias("customer_account_id"),
        n.cast("string").alias("comments"), F.lit("closed").alias("comment_on_close"), F.lit(1).alias("not shown"),
    )
    frames = {
        "customer_orders": orders, "cust_order_full": crm,
        "crm_cust_order_ids": spark.range(0, 300, 3).select(F.col("id").cast("double").alias("id")),
        "crm_customer": spark.range(30).select(
            F.col("id").cast("double").alias("customer_id"), F.lit("Ann").alias("name"),
            F.lit("i").alias("identification_number"), F.lit("m").alias("mobile_phone"),
        ),
    }
    made = {}
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
        made[name] = spark.read.parquet(f"{tmp_path}/{name}")
    return made


def _rounds(monkeypatch):
    seen, staged = {}, A._staged
    monkeypatch.setattr(A, "_staged", lambda name, *parts: (seen.update({name: len(parts)}), staged(name, *parts))[1])
    return seen


def test_a_large_history_goes_in_rounds_with_the_same_result(spark, tmp_path, rows, monkeypatch):
    frames, seen = _history(spark, tmp_path), _rounds(monkeypatch)
    whole = rows(A.assemble_history(frames, "1 day", tables.HISTORY_TIEBREAK))
    assert seen == {"unregistered": 1} and sum(r[-1] for r in whole) > 20
    monkeypatch.setattr(A, "ROUND_BYTES", -(-scanned_bytes(frames["cust_order_full"]) // 3))
    assert rows(A.assemble_history(frames, "1 day", tables.HISTORY_TIEBREAK)) == whole and seen["latest"] == 3
    monkeypatch.setattr(A, "ROUND_BYTES", 1)
    assert rows(A.assemble_history(frames, "1 day", tables.HISTORY_TIEBREAK)) == whole and seen["latest"] == A.ROUNDS


def test_a_round_exchanges_its_share_only(spark, tmp_path):
    """The share of order ids is cut from both tables that the provided CRM history is joined from."""
    lines, orders = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("lineitem", "orders"))
    share = tables.crm_orders(lines, orders).where(F.pmod(F.xxhash64("cust_order_id"), F.lit(8)) == 3)
    text = share._jdf.queryExecution().executedPlan().toString()
    assert sum("Filter" in line and "pmod(" in line for line in text.splitlines() if "FileScan" not in line) == 2


def test_only_known_sizes_are_counted(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/ids")
    df, size = spark.read.parquet(f"{tmp_path}/ids"), sum(p.stat().st_size for p in Path(f"{tmp_path}/ids").glob("*.parquet"))
    assert scanned_bytes(df) == size and scanned_bytes(df.join(df.select("id"), "id")) == 2 * size
    assert scanned_bytes(spark.createDataFrame([(1,)], "id long").union(df)) == size


@pytest.fixture
def shuffle_files(spark):
    folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return lambda: {p.name for f in folders for p in Path(f).rglob("shuffle_*")}


def test_builds_leave_no_shuffle_files(spark, tmp_path, conf, shuffle_files):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    frames, path = _history(spark, tmp_path), f"{tmp_path}/days"
    before = shuffle_files()
    for status in ("new", "other"):
        df = A.assemble_history(frames, "1 day", tables.HISTORY_TIEBREAK).withColumn("status", F.lit(status))
        assert D.write_days(df, path, "entry_date", grain="month")["written"]
    assert not shuffle_files() - before


def test_shuffle_files_stay_elsewhere(spark, conf):
    for value in (None, "false", "true"):
        spark.conf.unset(CLEANED) if value is None else conf(**{CLEANED.replace(".", "__"): value})
        with pytest.raises(ZeroDivisionError), passing_shuffles(spark):
            assert spark.conf.get(CLEANED) == "true"
            1 / 0
        assert spark.conf.get(CLEANED, None) == value
