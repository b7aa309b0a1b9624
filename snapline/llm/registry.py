"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import snapline
from snapline.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Texts that a Python worker holds at once: two workers share what an executor's heap leaves.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

_shipped: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """A tuned session whose Python workers, wherever they run, can import this package.

    The sources go to the executors through Spark (as with ``--py-files``), once per application.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = Path(snapline.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="snapline-")) / "snapline_sources.zip"
        with zipfile.ZipFile(archive, "w") as made:
            for source in sorted(home.rglob("*.py")):
                made.write(source, source.relative_to(home.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return tune(spark)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(ready(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
