"""Quality by importance resampling.

Two generative models of hashed n-grams, of target text (rows labelled good) and of raw text (all
rows), give each text an importance weight: the ratio of its probabilities under the two, per n-gram
and for ``LENGTH`` n-grams, so that long texts do not decide by their length. Adding Gumbel noise to
the logarithms and taking the k greatest draws k rows without replacement in proportion to the
weights. The noise comes from a hash of the row, so a repeated or recovered task draws alike.

Counts cover all rows and are summed by Spark; the models have a fixed size. The k-th greatest value
is found by counting in ever finer bins, not by gathering the rows.

Defined results: null and empty texts have weight 0 (logarithm 0: neither likelier); labels and ids
that are null are not learned from; of several labels of an id the good one counts; without target
text all weights are equal; equal keys at the cut are all kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.llm.arrays import PIECE, hash_spans, row_slices, text_bytes
from snapline.session import scratch

GRAMS = (2, 4)  # bytes
BUCKETS = 1 << 16
SMOOTHING = 1.0
LENGTH = 200
SHARE = 0.5
SEED = 3
# Labelled rows up to which the label table is broadcast; beyond, it is a shuffled join.
BROADCAST_LABELS = 2_000_000
# Rows that may be left in a bin for the driver to sort, and bins of a pass.
LEFT, BINS = 1000, 4096

_VALUE = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64)
_SHIFT = np.uint64(64 - 16)


def grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all n-grams of whole texts, a piece of the bytes at a time."""
    step = PIECE // 2
    for low in range(0, len(data), step):
        part = data[low : low + step + max(GRAMS)]
        at = np.arange(min(step, len(data) - low))
        row = np.searchsorted(bounds, at + low, "right") - 1
        for n in GRAMS:
            whole = at + low + n <= bounds[row + 1]
            yield row[whole], (hash_spans(part, at[whole], at[whole] + n, _VALUE) >> _SHIFT).astype(np.int64)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, target: Column) -> np.ndarray:
    """Per bucket the logarithm of its probability in target text over that in all text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for low, high in row_slices(bounds, PIECE):
                own = bounds[low : high + 1]
                for row, bucket in grams(data[own[0] : own[-1]], own - own[0]):
                    n[0] += np.bincount(bucket, minlength=BUCKETS)
                    n[1] += np.bincount(bucket[good[low:high][row]], minlength=BUCKETS)
        used = np.flatnonzero(n[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[0, used]), pa.array(n[1, used])], names=["bucket", "n", "t"])

    rows = docs.select("text", F.coalesce(target, F.lit(False)).alias("target")).mapInArrow(counted, "bucket long, n long, t long")
    summed = rows.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    n = np.zeros((2, BUCKETS))
    n[:, summed.column("bucket").to_numpy()] = [summed.column("n").to_numpy(), summed.column("t").to_numpy()]
    if not n[1].sum():
        return np.zeros(BUCKETS)
    raw, good = np.log(n + SMOOTHING) - np.log(n.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return good - raw


def weigh(docs: DataFrame, ratio: np.ndarray, columns: list[str]) -> DataFrame:
    """``columns`` and ``log_weight`` per row."""
    schema = docs.select(*columns).schema.add("log_weight", "double")
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            total, n = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
            for low, high in row_slices(bounds, PIECE):
                own = bounds[low : high + 1]
                for row, bucket in grams(data[own[0] : own[-1]], own - own[0]):
                    total[low:high] += np.bincount(row, weights=shared.value[bucket], minlength=high - low)
                    n[low:high] += np.bincount(row, minlength=high - low)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(LENGTH * total / np.maximum(n, 1))], names=schema.fieldNames())

    return docs.select("text", *columns).mapInArrow(weighed, schema)


def kth_greatest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th greatest value of a column of finite numbers (None for k = 0)."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or not n:
        return None
    if k >= n:
        return low
    rows = df.where(F.col(column).isNotNull())
    while True:
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / BINS
        if n <= LEFT or width <= abs(high) * 1e-15:
            return sorted((r[0] for r in inside.select(column).collect()), reverse=True)[k - 1] if n <= LEFT else low
        bins = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1)).alias("bin")
        counts = inside.groupBy(bins).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for b in sorted(counts, key=lambda r: -r["bin"]):
            if k <= b["n"]:
                low, high, n = b["low"], b["high"], b["n"]
                break
            k -= b["n"]


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, log_weight, sample_key, selected``: ``share`` of all rows is selected.

    Labels of rows whose id's CRC-32 divides by 5 are held out.
    """
    good = labels.where((F.col("quality") > 0) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__good")).distinct()
    if good.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"))
    ratio = train(rows.join(good, F.col("doc_id") == F.col("__good"), "left"), F.col("__good").isNotNull() & ~F.col("held_out"))
    drawn = F.xxhash64(F.lit(SEED), "doc_id", "text")
    # 53 bits, in the middle of their steps: never 0 or 1.
    uniform = (F.shiftrightunsigned(drawn, 11).cast("double") + 0.5) / float(1 << 53)
    noisy = rows.withColumn("noise", -F.log(-F.log(uniform)))
    weighed = weigh(noisy, ratio, ["doc_id", "held_out", "noise"]).withColumn("sample_key", F.col("log_weight") + F.col("noise"))
    path = scratch(docs.sparkSession, "weights")
    weighed.drop("noise").write.parquet(path)
    keyed = docs.sparkSession.read.parquet(path)
    n = keyed.count()
    cut = kth_greatest(keyed, "sample_key", int(-(-n * share // 1)))
    return keyed.withColumn("selected", F.lit(False) if cut is None else F.col("sample_key") >= cut)
