"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# None of these changes a result; they let the runtime split hot partitions,
# coalesce small ones and drop join input early.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split of a hot partition may cost one more exchange further up; take it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

# Above 2,000 shuffle partitions a map output reports only the average of its blocks, unless a
# block is this many times the median; without it the runtime sees no hot partition there.
SKEW_FACTOR = "spark.shuffle.accurateBlockSkewedFactor"

# Only at start. Without the first every Column call records its Python call site.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false", SKEW_FACTOR: "5"}

# Shuffle partitions before coalescing: input bytes grow about threefold when decoded,
# and a task should sort 128 MB in memory.
BYTES_PER_PARTITION = 128 << 20
DECODED = 3
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Spark's size of what it does not know the size of is the greatest BIGINT.
_UNKNOWN = 1 << 62

_own_scratch: str | None = None
_warned: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session that somebody else built.

    :data:`START_SETTINGS` cannot be set any more then: a cluster's defaults have to hold
    ``spark.shuffle.accurateBlockSkewedFactor``, or hot keys stay unsplit beyond 2,000 shuffle
    partitions. It is warned of once per application.
    """
    context = spark.sparkContext
    if float(context.getConf().get(SKEW_FACTOR, "-1")) <= 0 and context.applicationId not in _warned:
        _warned.add(context.applicationId)
        log.warning("%s is not set: beyond 2,000 shuffle partitions hot keys will not be split", SKEW_FACTOR)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes below ``paths``; what cannot be listed (a table, a query) counts as nothing."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(place):
            total += system.getContentSummary(place).getLength()
    return total


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` scans; what has no known size (a query, rows in memory) counts as nothing."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs of frames made inside delete their shuffle files as they end; otherwise these stay until the
    driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANED, None)
    spark.conf.set(_CLEANED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANED)
        else:
            spark.conf.set(_CLEANED, before)


def partitions_for(size: int, most: int | None = None) -> int:
    """Shuffle partitions for so many bytes of input, at most ``most`` if the cluster needs a bound."""
    wanted = max(1, -(-size * DECODED // BYTES_PER_PARTITION))
    return min(wanted, most) if most else wanted


def size_shuffles(spark: SparkSession, *paths: str, most: int | None = None) -> int:
    """Start shuffles with enough partitions for the input below ``paths``.

    Adaptive execution merges what turns out too small, so this only has to be large
    enough; it never goes below ``spark.sql.shuffle.partitions``.
    """
    wanted = partitions_for(input_bytes(spark, *paths), most)
    partitions = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(_INITIAL, str(partitions))
    return partitions


def build_session(app: str = "snapline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`, UTC, and any extra ``conf``."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset and everything runs in one process (tests) is it a local folder.
    """
    global _own_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if _own_scratch is None:
            _own_scratch = tempfile.mkdtemp(prefix="snapline-")
        base = _own_scratch
    return f"{base.rstrip('/')}/snapline/{name}-{uuid.uuid4().hex}"
