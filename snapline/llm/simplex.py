"""Centroid clustering: exact integer k-means whose assignments are filtered by n-simplex projection.

Some vectors serve as pivots. Their mutual distances fix a simplex, and the distances of a vector to
them fix the apex above that simplex: as many coordinates as there are pivots, of which the last,
the altitude, is not negative. Two vectors are at least as far from each other as their apexes, and
at most as far as one apex from the other's mirror image below the simplex. The distances to the
pivots never change, so they are computed once and written with the vectors; a round makes apexes of
them and of the centroids, drops every centroid whose lower bound exceeds the least upper bound or the exact
distance to the likeliest centroid, and compares what is left by exact integer distances.

A round is one pass over the vectors: each task sums its own vectors by centroid, Spark adds up these
few rows, and at most ``k`` sums reach the driver. Nothing else is broadcast than centroids and
pivots, whose number the caller states.

Defined results: rows without exactly ``size`` components, or with one that is null or not finite,
are left out; a component is the whole number ``floor(scale * x)``, at most ``LIMIT`` from zero, as
a squared distance would not fit 64 bits beyond; equal distances go to the smaller centroid number;
repeated rows are separate vectors (as starts, equal hashes are ordered by their components); a null
id hashes like an empty text; of fewer vectors than ``k`` each is a start; an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from snapline.session import scratch

SIZE, SCALE, CLUSTERS, ROUNDS, PIVOTS, SEED = 64, 256, 40, 5, 40, 2
LIMIT = 1 << 27
# A pivot whose altitude above the simplex of those before it is a smaller share of its distance adds nothing.
FLAT = 1e-6
# Share of the squares by which rounding may shift a bound.
SLACK = 1e-9


def whole(column: str, scale: int) -> Column:
    """The components as whole numbers."""
    low, high = F.lit(float(-LIMIT)), F.lit(float(LIMIT))
    return F.transform(column, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale).cast("double"), low), high).cast("int"))


def vectors(df: DataFrame, id_col: str, column: str, size: int, scale: int) -> DataFrame:
    """``id, q`` of the rows that have all components."""
    some = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # Tested apart, so that no broken component is ever converted.
    kept = df.where(F.col(column).isNotNull() & (F.size(column) == size)).where(some)
    return kept.select(F.col(id_col).alias("id"), whole(column, scale).alias("q"))


def starts(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the least hashes, in their order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = rows.orderBy(mark, "q").limit(k).select("q").collect()
    return np.array([r["q"] for r in found], dtype=np.int64)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all of ``a`` to each of ``b``."""
    made = np.empty((len(a), len(b)), np.int64)
    for j, other in enumerate(b):
        diff = a - other
        made[:, j] = np.einsum("ij,ij->i", diff, diff)
    return made


@dataclass
class Simplex:
    """Pivots, and the coordinates of each in the space of those before it."""

    pivots: np.ndarray
    corners: np.ndarray

    def apexes(self, squares: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots; the last is the altitude."""
        squares = squares.astype(np.float64)
        n = len(self.corners)
        made = np.zeros((len(squares), n))
        for j in range(1, n):
            own = self.corners[j]
            reach = squares[:, 0] - squares[:, j] + own @ own - 2 * made[:, : j - 1] @ own[: j - 1]
            made[:, j - 1] = reach / (2 * own[j - 1])
        made[:, n - 1] = np.sqrt(np.maximum(squares[:, 0] - np.einsum("ij,ij->i", made[:, : n - 1], made[:, : n - 1]), 0))
        return made


def simplex(candidates: np.ndarray, most: int) -> Simplex:
    """Each next pivot is the candidate highest above the simplex so far."""
    chosen, corners = [0], np.zeros((1, 0))
    while len(chosen) < min(most, len(candidates)):
        made = Simplex(candidates[chosen], np.pad(corners, ((0, 0), (0, 1))))
        squares = _squares(candidates, candidates[chosen])
        apex = made.apexes(squares)
        height = apex[:, -1]
        height[chosen] = 0
        best = int(np.argmax(height))
        if height[best] <= FLAT * np.sqrt(max(float(squares[best].max()), 1.0)):
            break
        corners = np.vstack([made.corners, apex[best]])
        chosen.append(best)
    return Simplex(candidates[chosen], np.pad(corners, ((0, 0), (0, 1))))


def bounds(own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of each vector to each centroid, from their
    apexes, with room for rounding."""
    both = np.einsum("ij,ij->i", own, own)[:, None] + np.einsum("ij,ij->i", others, others)
    low = both - 2 * own @ others.T
    slack = SLACK * both + 1e-6
    return low - slack, low + 4 * np.outer(own[:, -1], others[:, -1]) + slack


def _exact(q: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    diff = q - centroid
    return np.einsum("ij,ij->i", diff, diff)


def nearest(q: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid (the smaller number if equal), its squared distance, and how many distances were computed.

    A centroid is left out if its lower bound passes the least upper bound, or the exact distance to the
    centroid whose lower bound is least.
    """
    guess = low.argmin(axis=1)
    best = _exact(q, centroids[guess])
    maybe = low <= np.minimum(high.min(axis=1), best + 0.5)[:, None]
    maybe[np.arange(len(q)), guess] = False
    cluster = guess.astype(np.int32)
    for j, centroid in enumerate(centroids):
        at = np.flatnonzero(maybe[:, j])
        distance = _exact(q[at], centroid)
        better = (distance < best[at]) | ((distance == best[at]) & (j < cluster[at]))
        best[at[better]], cluster[at[better]] = distance[better], j
    return cluster, best, len(q) + int(maybe.sum())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _cached(rows: DataFrame, base: Simplex) -> DataFrame:
    """Write the vectors with their squared distances to the pivots."""
    spark, size = rows.sparkSession, base.pivots.shape[1]
    schema = rows.select("id", "q").schema.add("squares", ArrayType(LongType()))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            squares = _squares(_matrix(batch.column(1), size), base.pivots)
            lists = pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * len(base.pivots), squares.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=schema.fieldNames())

    path = scratch(spark, "vectors")
    rows.mapInArrow(measured, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _assigned(batch: pa.RecordBatch, at: tuple[int, int], base: Simplex, centroids: np.ndarray, apexes: np.ndarray):
    q = _matrix(batch.column(at[0]), centroids.shape[1])
    own = base.apexes(_matrix(batch.column(at[1]), len(base.pivots)))
    return q, *nearest(q, *bounds(own, apexes), centroids)[:2]


def _moved(cached: DataFrame, base: Simplex, centroids: np.ndarray) -> np.ndarray:
    """One round: the floors of the means; a centroid without vectors stays."""
    apexes, size = base.apexes(_squares(centroids, base.pivots)), centroids.shape[1]
    names = ["cluster", "n", *(f"s{i}" for i in range(size))]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), size + 1), np.int64)
        for batch in batches:
            q, cluster, _ = _assigned(batch, (0, 1), base, centroids, apexes)
            np.add.at(total, cluster, np.column_stack([np.ones(len(q), np.int64), q]))
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(c) for c in total[used].T)], names=names)

    parts = cached.select("q", "squares").mapInArrow(summed, ", ".join(f"{n} long" for n in names))
    # Sums of very many large components may pass 64 bits.
    sums = parts.groupBy("cluster").agg(*[F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in names[1:]])
    moved = centroids.copy()
    for row in sums.collect():
        moved[row["cluster"]] = [int(row[n]) // int(row["n"]) for n in names[2:]]
    return moved


def clusters(
    df: DataFrame, id_col: str = "vec_id", column: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE,
    scale: int = SCALE, pivots: int = PIVOTS, seed: int = SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` (components) per vector."""
    spark = df.sparkSession
    rows = vectors(df, id_col, column, size, scale)
    centroids = starts(rows, k, seed)
    made = rows.select(F.col("id").alias("vec_id")).schema.add("cluster", "integer").add("distance", "long")
    if not len(centroids):
        return spark.createDataFrame([], made.add("cluster_inertia", "long").add("inertia", "long").add("centroid", ArrayType(LongType())))
    base = simplex(centroids, pivots)
    cached = _cached(rows, base)
    for _ in range(rounds):
        centroids = _moved(cached, base, centroids)
    apexes = base.apexes(_squares(centroids, base.pivots))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = _assigned(batch, (1, 2), base, centroids, apexes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)], names=made.fieldNames())

    path = scratch(spark, "clusters")
    cached.mapInArrow(assigned, made).write.parquet(path)
    found = spark.read.schema(made).parquet(path)
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    # One row a centroid: at most k.
    facts = [(j, s, sum(inertia.values()), centroids[j].tolist()) for j, s in inertia.items()]
    about = spark.createDataFrame(facts, "number int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(about), F.col("cluster") == F.col("number")).drop("number")


def centroid_sha256(centroid: str = "centroid") -> Column:
    return F.sha2(F.concat_ws(",", F.col(centroid).cast("array<string>")).cast("binary"), 256)
