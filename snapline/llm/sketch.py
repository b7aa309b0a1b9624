"""Document fingerprints by a threshold-scaled sketch, in built-in functions only.

Every shingle hash below a fixed fraction of the hash range is kept, whatever the text's length, so
the sketch of two texts together is the union of theirs, and the share of the smaller sketch that
the other one holds estimates containment also between very unequal documents. The least hash is
kept in any case, so that only texts without words have an empty sketch.

Defined results: a null text is empty; sketches of texts without words are empty, and alike by 1 to
each other and by 0 to others; the next document of an id is the one with the next smaller id (null
last), after the last the first, and of rows that share an id the one with the smallest MD5 of its text stands for it; a
single id is its own next one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapline.operators.joins import spread_join
from snapline.session import scratch

SHINGLE = 3
# One hash in 2^3 is kept; a kept hash is written as its upper 32 bits.
SCALE_BITS = 3
_LOWEST = -(1 << 63)
# Ids up to which the table of next ids (three numbers a row) is broadcast; beyond, it is a shuffled join.
BROADCAST_IDS = 2_000_000


def sketch(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """``df`` with the sorted sketch of a text column as array ``name``."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    df = df.withColumn("__words", words)
    n = F.size("__words")
    # Positions past the end are null and hash like nothing, so fewer words make one shingle.
    hashed = F.transform(
        F.slice("__words", F.lit(1), F.greatest(n - (SHINGLE - 1), F.least(n, F.lit(1)))),
        lambda w, i: F.xxhash64(w, *[F.get("__words", i + j) for j in range(1, SHINGLE)]),
    )
    df = df.withColumn("__hashes", hashed)
    kept = F.concat(F.filter("__hashes", lambda h: h < _LOWEST + (1 << (64 - SCALE_BITS))), F.filter(F.array(F.array_min("__hashes")), lambda h: h.isNotNull()))
    bits = F.transform(kept, lambda h: F.shiftright(h, 32).cast("int").bitwiseXOR(F.lit(-(1 << 31))))
    return df.withColumn(name, F.array_sort(F.array_distinct(bits))).drop("__words", "__hashes")


def text_form(name: str) -> Column:
    """A sketch as a string, eight hexadecimal digits a hash."""
    return F.concat_ws("", F.transform(name, lambda h: F.lower(F.lpad(F.hex(h.cast("bigint").bitwiseAND(F.lit((1 << 32) - 1))), 8, "0"))))


def likeness(a: str, b: str) -> Column:
    """Estimated containment of the smaller one: 0 to 1."""
    least = F.least(F.size(a), F.size(b))
    both_empty = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both_empty, 1.0).when(least == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def next_ids(ids: DataFrame) -> DataFrame:
    """``id, next``: each distinct id and the next smaller one, after the smallest the largest.

    Ids are dealt into ranges; within a range a window finds the next one, and between ranges only
    their first ids are compared, one row a range.
    """
    spark = ids.sparkSession
    path = scratch(spark, "ranges")
    down = F.col("id").desc_nulls_last()
    ids.select("id").distinct().repartitionByRange(down).withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    per_part = Window.partitionBy("part").orderBy(down)
    tops = dealt.groupBy("part").agg(F.max("id").alias("top"))
    over = Window.orderBy("part")
    tops = tops.select("part", F.lead(F.struct("top")).over(over).alias("after"), F.first(F.struct("top")).over(over.rowsBetween(Window.unboundedPreceding, 0)).alias("first"))
    near = dealt.withColumn("lead", F.lead(F.struct("id")).over(per_part))
    return near.join(tops, "part").select("id", F.coalesce(F.col("lead.id"), F.when(F.col("lead").isNull(), F.coalesce("after", "first")["top"])).alias("next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last third replaced by the next document's beginning. Texts are
    exchanged by id once, and with them only the beginnings that the document before needs.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # A null id is an id like others here; no other one is written as empty text.
    rows = rows.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit("")))
    third = (F.length("text") / 3).cast("int")
    path = scratch(spark, "needed")
    rows.groupBy("key", "id").agg(F.max(third).alias("need"), F.count("*").alias("rows")).write.parquet(path)
    needed = spark.read.parquet(path)
    n_ids, n_rows = needed.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    after = next_ids(needed).select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("before"), F.coalesce(F.col("next").cast("string"), F.lit("")).alias("next"))
    after = after.join(needed.select("key", "need"), F.col("before") == F.col("key")).select("before", "next", "need")
    path = scratch(spark, "next")
    after.write.parquet(path)
    after = spark.read.parquet(path)
    own = sketch(rows, "text", "theirs").select("key", F.md5("text").alias("digest"), "text", "theirs")
    own = own.join(F.broadcast(after), F.col("key") == F.col("next")) if n_ids <= BROADCAST_IDS else spread_join(own, after, [("key", "next")], "inner")
    begins = own.select("before", "digest", F.col("text").substr(F.lit(1), F.col("need")).alias("begin"), "theirs")
    if n_ids < n_rows:
        least = begins.groupBy("before").agg(F.min(F.struct("digest", "begin", "theirs")).alias("least"))
        begins = least.select("before", "least.begin", "least.theirs")
    n = F.length("text")
    edited = F.concat(F.col("text").substr(F.lit(1), n - third), F.col("begin").substr(F.lit(1), third))
    joined = spread_join(rows, begins.select("before", "begin", "theirs"), [("key", "before")], "inner")
    joined = sketch(joined.select("id", "text", n.alias("n_chars"), "theirs", edited.alias("edited")), "text", "own")
    made = sketch(joined, "edited", "changed")
    return made.select(
        F.col("id").alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        text_form("own").alias("fingerprint"),
        text_form("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "theirs").alias("near_next"),
    )
