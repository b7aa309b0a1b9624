"""SimHash near-dedup by pivot distance tables.

Fingerprints that differ in at most ``bits`` bits are linked. Each distinct fingerprint gets a
table of its Hamming distances to many reference fingerprints, kept block by block of the 64 bits
(the distances over all bits are their sums). Two linked fingerprints agree in all but ``bits`` of
the ``bits + 3`` blocks, so they have equal distances to every reference on some three blocks: those
distances are the join keys. By the triangle inequality no distance over all bits may differ by
more than ``bits``: pairs whose maximum coordinate difference is larger are discarded, and the rest
are verified bit by bit. Keys that many fingerprints share (dense clusters) make no pairs: their
members meet in star groups around common neighbours, see :func:`_dense_links`; together both ways
keep every link.

Defined results: null and empty texts have fingerprint zero, linked like any other; repeated rows
are separate documents; a null id never is a component's id unless all are null, and ties do not
decide anything but which of equal rows stays; very long texts are hashed a run of words at a time; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.llm.components import components
from snapline.operators.joins import spread_join
from snapline.session import scratch

SHINGLE, BITS, SEED = 3, 2, 42
REFERENCES = 16
# Members of a key beyond which it makes stars instead of pairs.
DENSE = 8
# Texts longer than this (bytes) are hashed a run of words at a time.
RUN_BYTES, RUN_WORDS = 1 << 20, 1 << 15

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def _runs(raw: bytes) -> Iterator[list[bytes]]:
    if len(raw) <= RUN_BYTES:
        yield raw.split()
        return
    found = (m.group() for m in _WORD.finditer(raw))
    while run := list(islice(found, RUN_WORDS)):
        yield run


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of each bit over the XXH64 hashes of all shingles, repeats included."""
    counts, n, before, digest = np.zeros(64, dtype=np.int64), 0, [], xxhash.xxh64_intdigest
    for run in _runs((text or "").encode().lower()):
        words = before + run
        hashes = [digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(shingle)))]
        if hashes:
            bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
        before = words[1 - shingle :] if shingle > 1 else []
    if not n and before:
        return digest(b" ".join(before), seed)
    return sum(1 << int(b) for b in np.flatnonzero(counts * 2 > n)) if n else 0


def fingerprints(docs: DataFrame, columns: list[str], text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``columns`` and ``fp``, the fingerprint as a signed 64-bit number."""
    schema = docs.select(*columns).schema.add("fp", "long")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps)], names=schema.fieldNames())

    return docs.select(F.col(text_col).alias("__text"), *columns).mapInArrow(hashed, schema)


def _blocks(n: int) -> list[int]:
    """Masks of ``n`` runs of bits that make up the 64."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [sum(1 << b for b in range(low, high)) for low, high in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """``key, fp, d0..``: the fingerprint under each of its keys, and its reference distances."""
    drawn = random.Random(1)
    references = [drawn.getrandbits(64) for _ in range(REFERENCES)]
    masks = _blocks(bits + 3)
    part = [
        [F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(r))).bitwiseAND(F.lit(_signed(m)))) for r in references]
        for m in masks
    ]
    whole = [reduce(add, column).cast("byte").alias(f"d{j}") for j, column in enumerate(zip(*part))]
    table = fps.select("fp", *whole, *[F.xxhash64(*p).alias(f"b{i}") for i, p in enumerate(part)])
    keys = [F.xxhash64(F.lit(k), *[f"b{i}" for i in chosen]) for k, chosen in enumerate(combinations(range(len(masks)), 3))]
    return table.select(F.explode(F.array(*keys)).alias("key"), "fp", *[f"d{j}" for j in range(REFERENCES)])


def _pair_links(table: DataFrame, bits: int) -> DataFrame:
    """Pairs under a key, discarded by the largest difference of their coordinates, then verified."""
    other = table.select(F.col("key").alias("__key"), F.col("fp").alias("v"), *[F.col(f"d{j}").alias(f"e{j}") for j in range(REFERENCES)])
    far: Column = F.greatest(*[F.abs(F.col(f"d{j}") - F.col(f"e{j}")) for j in range(REFERENCES)])
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= bits
    on = (F.col("key") == F.col("__key")) & (F.col("fp") < F.col("v")) & (far <= bits) & near
    return table.join(other, on).select(F.col("fp").alias("u"), "v")


def _dense_links(fps: DataFrame, bits: int) -> DataFrame:
    """Links among fingerprints in dense clusters, without pairs.

    Two fingerprints differ in at most two bits exactly if some value is within one bit of both.
    So each goes to the 65 values within one bit of it; a value has 65 members at most, and all
    of them are linked to each other.
    """
    if bits != 2:
        raise ValueError("stars need a distance of two bits")
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(64)])
    groups = fps.select("fp", F.explode(around).alias("z")).groupBy("z").agg(F.collect_set("fp").alias("near"))
    return groups.where(F.size("near") > 1).select(F.array_min("near").alias("u"), F.explode("near").alias("v")).where("u <> v")


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Enough links ``u, v`` between distinct fingerprints ``fp`` to connect all that are within ``bits``."""
    spark = fps.sparkSession
    path = scratch(spark, "pivots")
    pivot_table(fps, bits).write.parquet(path)
    table = spark.read.parquet(path)
    shared = table.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    path = scratch(spark, "shared")
    shared.write.parquet(path)
    shared = spark.read.parquet(path)
    sparse = spread_join(table, shared.where(F.col("n") <= DENSE).select(F.col("key").alias("k")), [("key", "k")], "left_semi")
    dense = spread_join(table, shared.where(F.col("n") > DENSE).select(F.col("key").alias("k")), [("key", "k")], "left_semi")
    return _pair_links(sparse, bits).union(_dense_links(dense.select("fp").distinct(), bits)).distinct()


def roots(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """``fp, root``: the component of each distinct fingerprint, named by its least one."""
    found = components(links(fps, bits)).select("u", F.col("v").alias("root"))
    return fps.join(found, F.col("fp") == F.col("u"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per document."""
    spark = docs.sparkSession
    path = scratch(spark, "fingerprints")
    fingerprints(docs.withColumn("__id", F.col(id_col)), ["__id"], text_col, shingle).write.parquet(path)
    rows = spark.read.parquet(path)
    distinct = rows.groupBy("fp").agg(F.min("__id").alias("least"))
    named = roots(distinct.select("fp"), bits)
    labelled = distinct.join(named.withColumnRenamed("fp", "f"), F.col("fp") == F.col("f")).select("f", "root", "least")
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r")
    by_fp = spread_join(labelled, ids, [("root", "r")], "inner").select("f", "component_id")
    return spread_join(rows, by_fp, [("fp", "f")], "inner").select(
        F.col("__id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group: the least id, then the least digest of the text, then
    the least hash of the row; of repeated rows one."""
    spark = docs.sparkSession
    # The user's columns travel in one struct, so their names clash with none here; the digest stands for the text.
    row = F.struct(*[f"`{c}`" for c in docs.columns])
    rest = F.struct(F.col(text_col).isNull().alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col])
    digest, mark = F.coalesce(F.md5(F.col(text_col)), F.lit("")), F.xxhash64(F.to_json(rest))
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), digest.alias("digest"), mark.alias("mark"), row.alias("row"))
    path = scratch(spark, "fingerprints")
    fingerprints(keyed, ["id", "digest", "mark"], "text", shingle).write.parquet(path)
    rows = spark.read.parquet(path)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest", "mark"))
    distinct = rows.groupBy("fp").agg(first.alias("least"))
    named = roots(distinct.select("fp"), bits).withColumnRenamed("fp", "f")
    chosen = distinct.join(named, F.col("fp") == F.col("f")).groupBy("root").agg(F.min("least").alias("least"))
    chosen = chosen.select("root", *[F.col("least").getField(c).alias(f"kept_{c}") for c in ("id", "digest", "mark")])
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")) & (F.col("mark") == F.col("kept_mark"))
    kept = keyed.join(chosen, same).dropDuplicates(["root"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
