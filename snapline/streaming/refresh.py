"""Keeping derived tables current from a stream, without rewriting them per batch.

A table is a base in buckets of its key's hash, plus the reduced output of every batch since:

    <path>/current.json                 {"buckets": {<bucket>: <id>}, "of": <buckets>, "upto": <batch>}
    <path>/base/<id>/key_bucket=<bucket>/*.parquet
    <path>/changes/batch_id=<n>/*.parquet

A batch replayed after a failure overwrites its own folder, so it counts once. Readers
merge on read; :func:`compact` folds the changes into the base: it rewrites the buckets that the
changes touch, all others keep their files, and a bucket is the unit a reader of some keys needs.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapline.functions.dates import instant_day, wall_instant
from snapline.operators.latest import latest_by
from snapline.sources import files

_NEVER = -1
# Buckets of a new table; a table keeps the number it began with.
BUCKETS = 16
FOLDER = "key_bucket"


def stream_table(spark: SparkSession, path: str, schema=None, max_files: int | None = None) -> DataFrame:
    """A Parquet table, a folder or one file, as a stream; ``max_files`` bounds a batch, so that
    a backlog becomes many batches instead of one."""
    path = path.rstrip("/")
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # The file source takes paths as patterns: signs that mean something there are bracketed.
    plain = re.sub(r"([\[\]{}*?\\])", r"[\1]", path) if re.search(r"[\[\]{}*?\\]", path) else path
    # It refuses a plain file, but takes a pattern that fits only it.
    return reader.parquet(f"{plain[:-1]}[{plain[-1]}]" if files.is_file(spark, path) else plain)


def _state(spark: SparkSession, path: str, buckets: int = BUCKETS) -> dict:
    pointer = f"{path}/current.json"
    if not files.exists(spark, pointer):
        return {"buckets": {}, "of": buckets, "upto": _NEVER}
    return json.loads(files.read_text(spark, pointer))


def bucket_of(keys: Sequence[str], of: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(of)).cast("int")


def _base(spark: SparkSession, path: str, buckets: dict[str, str]) -> DataFrame | None:
    """The rows of some buckets, given the id that each was last written under."""
    folders = sorted(f"{path}/base/{made}/{FOLDER}={bucket}" for bucket, made in buckets.items())
    return spark.read.parquet(*folders) if folders else None


def _changes(spark: SparkSession, path: str, after: int) -> DataFrame | None:
    if not files.children(spark, f"{path}/changes"):
        return None
    changes = spark.read.parquet(f"{path}/changes").where(F.col("batch_id") > after)
    return changes.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _together(base: DataFrame | None, changes: DataFrame | None, path: str) -> DataFrame:
    parts = [df for df in (base, changes) if df is not None]
    if not parts:
        raise ValueError(f"nothing has been written to {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _merged(spark: SparkSession, path: str, state: dict) -> DataFrame:
    return _together(_base(spark, path, state["buckets"]), _changes(spark, path, state["upto"]), path)


def _write_change(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")


def _start(stream: DataFrame, handler, path: str, mode: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handler)
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )


def refresh_latest(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] = (),
    compact_every: int | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Append each batch's latest row per key; stops when the source is read up.

    ``compact_every`` folds the changes into the base after that many batches.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_change(latest_by(batch, keys, order, tiebreak), path, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, keys, order, tiebreak, buckets)

    return _start(stream, handle, path, "append")


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The latest row per key over everything streamed so far."""
    rows = _merged(spark, path, _state(spark, path)).drop("batch_id")
    return latest_by(rows, keys, order, tiebreak)


def read_keys(
    spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The latest rows of the keys in ``wanted`` (columns ``keys``); only their buckets of the base are read."""
    state = _state(spark, path)
    wanted = wanted.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    own = {str(r[0]) for r in wanted.select(bucket_of(keys, state["of"])).distinct().collect()}  # at most all buckets
    base = _base(spark, path, {b: made for b, made in state["buckets"].items() if b in own})
    changes = _changes(spark, path, state["upto"])
    if base is None and changes is None and state["buckets"]:
        base = _base(spark, path, dict([*state["buckets"].items()][:1])).limit(0)
    rows = _together(base, changes, path).drop("batch_id").join(wanted, list(keys), "left_semi")
    return latest_by(rows, keys, order, tiebreak)


def refresh_counts(
    stream: DataFrame, path: str, ts: str, dims: Sequence[str], watermark: str | None = None,
    compact_every: int | None = None, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Rows per day and ``dims``; each batch appends the totals it changed, and ``compact_every``
    batches they are folded into the base.

    The state is one row per day and ``dims``. A ``watermark`` closes older days, which
    makes it smaller still, but then later arrivals for a closed day are not counted.
    """
    total = F.count(F.lit(1)).alias("cnt")
    if watermark:
        # Event time has to be an instant.
        timed = stream.withColumn("__at", wall_instant(ts)).withWatermark("__at", watermark)
        counts = timed.groupBy(F.window("__at", "1 day").alias("__window"), *dims).agg(total)
        counts = counts.select(instant_day("__window.start").alias("day"), *dims, "cnt")
    else:
        counts = stream.groupBy(F.to_date(ts).alias("day"), *dims).agg(total)

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_change(batch, path, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, ["day", *dims], ["batch_id"], buckets=buckets)

    return _start(counts, handle, path, "update")


def read_counts(spark: SparkSession, path: str, dims: Sequence[str]) -> DataFrame:
    """The newest total per day and ``dims``."""
    rows = _merged(spark, path, _state(spark, path))
    return latest_by(rows, ["day", *dims], ["batch_id"]).drop("batch_id")


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = (), buckets: int = BUCKETS
) -> None:
    """Fold all changes into the base, bucket by bucket; what no change touches is neither read nor written.
    A new table gets so many ``buckets``.

    The pointer is replaced last, so readers and a running stream never see a gap. For counts,
    ``keys`` is day and dims, ``order`` the batch. What the compaction before this one had already
    replaced is deleted now: readers that started on the old pointer still find their files.
    """
    state = _state(spark, path, buckets)
    batches = {
        int(name.split("=")[1]): name for name in files.children(spark, f"{path}/changes") if "=" in name
    }
    if not batches or max(batches) <= state["upto"]:
        return
    upto, made = max(batches), uuid.uuid4().hex
    changes = _changes(spark, path, state["upto"]).where(F.col("batch_id") <= upto)
    touched = {str(r[0]) for r in changes.select(bucket_of(keys, state["of"])).distinct().collect()}  # at most all buckets
    base = _base(spark, path, {b: i for b, i in state["buckets"].items() if b in touched})
    rows = latest_by(_together(base, changes, path), keys, order, tiebreak).withColumn(FOLDER, bucket_of(keys, state["of"]))
    # One file a small bucket; a large one is split into several tasks.
    rows.hint("rebalance", FOLDER).write.partitionBy(FOLDER).parquet(f"{path}/base/{made}")
    now = {**state["buckets"], **{b: made for b in touched}}
    files.replace_text(spark, f"{path}/current.json", json.dumps({"buckets": now, "of": state["of"], "upto": upto}))
    for batch_id, name in batches.items():
        if batch_id <= state["upto"]:
            files.delete(spark, f"{path}/changes/{name}")
    kept = {(i, b) for buckets in (now, state["buckets"]) for b, i in buckets.items()}
    for name in files.children(spark, f"{path}/base"):
        own = {b for i, b in kept if i == name}
        if not own:
            files.delete(spark, f"{path}/base/{name}")
            continue
        for folder in files.children(spark, f"{path}/base/{name}"):
            if "=" in folder and folder.split("=")[1] not in own:
                files.delete(spark, f"{path}/base/{name}/{folder}")
