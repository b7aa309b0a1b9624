"""A grid laid out for its pages: files in page order, and a small table of where each begins and ends.

    <path>/rows/*.parquet     the rows in page order, so many a file at most
    <path>/files/*.parquet    per file: its place in the order, rows, first and last position

A page behind (or before) a position is read from the files that hold it: the first file whose last row
is beyond the position and as many next ones as it takes to fill the page, usually two in all. The
total and a page's number come from the table of files alone.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapline.operators.grid import PAGE_SIZE, default_sort, grid_page_after, grid_sort
from snapline.sources import files

ROWS_PER_FILE = 100_000
_LAYOUT = "layout.json"


def write_pages(
    df: DataFrame, path: str, tiebreak: str, sort: str | None = None, desc: bool = True, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Sort once and write; ``tiebreak`` is a unique, non-NULL column."""
    spark, sort = df.sparkSession, sort or default_sort(df)
    ordered = grid_sort(df, sort, desc, [tiebreak])
    ordered.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    written = spark.read.schema(df.schema).parquet(f"{path}/rows")
    place = F.col("_metadata.row_index")
    position = F.struct(F.col(f"`{sort}`").alias("value"), F.col(f"`{tiebreak}`").alias("id"))
    # Rows of a file are in order, so its first and last tell where it lies; its name tells its turn.
    facts = written.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name")).agg(
        F.count(F.lit(1)).alias("rows"), F.min_by(position, place).alias("first"), F.max_by(position, place).alias("last")
    )
    turn = [F.regexp_extract("name", pattern, 1).cast("bigint") for pattern in (r"^part-(\d+)", r"-c(\d+)\.")]
    facts.select("file", F.struct(*turn).alias("turn"), "rows", "first", "last").coalesce(1).write.parquet(f"{path}/files")
    files.write_text(spark, f"{path}/{_LAYOUT}", json.dumps({"sort": sort, "desc": desc, "tiebreak": tiebreak, "schema": df.schema.json()}))


class Pages:
    """A grid written by :func:`write_pages`."""

    def __init__(self, spark: SparkSession, path: str):
        layout = json.loads(files.read_text(spark, f"{path}/{_LAYOUT}"))
        self.spark, self.sort, self.desc, self.tiebreak = spark, layout["sort"], layout["desc"], layout["tiebreak"]
        self.schema = StructType.fromJson(json.loads(layout["schema"]))
        self.files = spark.read.parquet(f"{path}/files")

    def total(self) -> DataFrame:
        return self.files.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"))

    def _beyond(self, edge: str, value: Any, place: Any, back: bool) -> Column:
        """Does a file's row at its ``edge`` follow (or precede) a position in page order?"""
        own, unique = F.col(f"{edge}.value"), F.col(f"{edge}.id")
        here = F.lit(value).cast(self.schema[self.sort].dataType)
        further = (own > here) if self.desc == back else (own < here)
        same = unique < place if back else unique > place
        if value is None:
            return (own.isNull() & same) | (F.lit(back) & own.isNotNull())
        return further | ((own == here) & same) | (F.lit(not back) & own.isNull())

    def _held(self, test: Column, size: int, back: bool) -> list[str]:
        """The nearest files for which ``test`` holds: one, and those that fill a page if it gave one row."""
        order = F.col("turn").desc() if back else F.col("turn").asc()
        before = F.sum("rows").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
        first = F.first("rows").over(Window.orderBy(order))
        # One row a file; what lies before a file without the first file's rows but one is already enough.
        found = self.files.where(test).withColumn("before", F.coalesce(before - first + 1, F.lit(0))).where(F.col("before") < size)
        return [r["file"] for r in found.select("file").collect()]

    def _page(self, wanted: list[str]) -> DataFrame:
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*wanted)

    def first(self, size: int = PAGE_SIZE) -> DataFrame:
        rows = self._page(self._held(F.lit(True), size + 1, False))
        return grid_sort(rows, self.sort, self.desc, [self.tiebreak]).limit(size)

    def after(self, value: Any, place: Any, size: int = PAGE_SIZE) -> DataFrame:
        """The page behind the row with this sort value and tie-break value."""
        rows = self._page(self._held(self._beyond("last", value, place, False), size, False))
        return grid_page_after(rows, self.sort, self.desc, self.tiebreak, (value, place), size)

    def before(self, value: Any, place: Any, size: int = PAGE_SIZE) -> DataFrame:
        """The page before it."""
        rows = self._page(self._held(self._beyond("first", value, place, True), size, True))
        return grid_page_after(rows, self.sort, self.desc, self.tiebreak, (value, place), size, back=True)
