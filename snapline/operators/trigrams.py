"""Search without reading every file: which trigrams occur in a file, as a bitmap of hashes.

Each cell's text, in lower case, gives its runs of three signs; a file's bitmap has a bit for the hash
of each. A term can only be found in files whose bitmaps have the bits of all its trigrams, so the
others are not opened. Hashes that collide and trigrams from different cells only keep a file that
need not be read; the search itself then decides row by row as ever.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.functions.texts import text_of
from snapline.operators.grid import grid_search

# Bits of a file's bitmap (a power of two); 64 of them are a row of the index.
BITS = 1 << 16


def _slot(trigram, bits: int):
    return F.pmod(F.xxhash64(trigram), F.lit(bits))


def file_trigrams(df: DataFrame, bits: int = BITS) -> DataFrame:
    """``file, word, held`` of a frame read from files: 64 bits of a file's bitmap a row.

    The trigrams are folded into bits before the exchange: a task sends one row for each word of a file.
    """
    cells = F.array(*[F.lower(text_of(df, c)) for c in df.columns])
    rows = df.select(F.col("_metadata.file_path").alias("file"), F.explode(cells).alias("cell")).where(F.length("cell") >= 3)
    grams = F.transform(F.sequence(F.lit(1), F.length("cell") - 2), lambda i: _slot(F.substring(F.col("cell"), i, F.lit(3)), bits))
    slots = rows.select("file", F.explode(F.array_distinct(grams)).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    return slots.groupBy("file", F.floor(F.col("slot") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("held"))


def literal_of(term: str) -> str:
    """What any match must hold: the term itself, or the longest part between its wildcards."""
    return max(re.split("[%_]", term.strip().lower()), key=len)


def _place(file: str) -> str:
    """A file's address; Spark writes it with one or three slashes, escaped or not."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", unquote(file))


def files_for(index: DataFrame, files: Sequence[str], term: str, bits: int = BITS) -> list[str]:
    """Those of ``files`` that may hold the term; too short a literal leaves all."""
    literal = literal_of(term)
    if len(literal) < 3:
        return list(files)
    spark = index.sparkSession
    grams = spark.createDataFrame([(literal[i : i + 3],) for i in range(len(literal) - 2)], "gram string").distinct()
    needed = grams.select(_slot("gram", bits).alias("slot")).distinct()
    needed = needed.groupBy(F.floor(F.col("slot") / 64).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("mask"))
    masks = {r["at"]: r["mask"] for r in needed.collect()}  # at most a row for each sign of the term
    test = F.lit(False)
    for word, mask in masks.items():
        test = test | ((F.col("word") == word) & (F.col("held").bitwiseAND(F.lit(mask)) == mask))
    found = index.where(F.col("word").isin(list(masks))).where(test).groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(masks))
    kept = {_place(r["file"]) for r in found.select("file").collect()}
    # Files that the index does not know are read.
    known = {_place(r["file"]) for r in index.select("file").distinct().collect()}
    return [f for f in files if _place(f) in kept or _place(f) not in known]


def indexed_search(data: DataFrame, index: DataFrame, term: str, bits: int = BITS) -> DataFrame:
    """``grid_search`` of a frame of Parquet files that opens only those that may hold the term."""
    files = data.inputFiles()
    if not term.strip():
        return data
    few = files_for(index, files, term, bits)
    if len(few) == len(files):
        return grid_search(data, term)
    if not few:
        return data.where(F.lit(False))
    return grid_search(data.sparkSession.read.schema(data.schema).parquet(*few), term)


def write_index(spark: SparkSession, data_path: str, index_path: str, bits: int = BITS) -> None:
    file_trigrams(spark.read.parquet(data_path), bits).write.parquet(index_path)
