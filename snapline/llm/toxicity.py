"""Toxicity by class-conditional Kneser-Ney models.

Two models of word pairs, toxic and ordinary, whose rare expressions fall back to counts of both:

    P_c(w | v) = (n_c(vw) - d_c(vw)) / n_c(v) + l_c(v) * P_c(w)
    P_c(w)     = (n_c(w) - d_c(w)) / n_c + l_c * q(w)
    q(w)       = (k(w) - d(w)) / k + l / (words + 1)

k(w), the continuation count, is how many different words precede w in either class (the start of a
text counts as a word), and each l is the mass that the discounts d have taken away, so every
distribution sums to one over the known words and one unknown. A pair is discounted by ``PAIR``. A
word's discount depends on its count n, as in modified Kneser-Ney smoothing: n D / (n + D), nearly
all of a rare word's and D of a frequent one's; the classes share D in proportion to their sizes, so
that a word as frequent in one as in the other loses the same share in both, and the far larger
ordinary class does not look surer of everything.

The evidence of a text is the difference of its two log-likelihoods per word, in two parts: what
P_c(w) says, less the median word's (which only tells what language and subject the labelled texts
of each class favour), and what P_c(w | v) adds to it. A logistic curve, fitted on labelled texts
that the counts have not seen, weighs the two and turns them into a probability.

The models are fitted on all labelled rows that may be learned from, a fifth of the ids for the
curve. Every word and pair of these is counted, however rare, under 64-bit keys: tasks count some
MB of texts, and buckets of pairs are added up. The words are broadcast up to ``TABLE_BYTES``, and
of the pairs the more frequent ones up to ``PAIR_BYTES``; what the other pairs add to a text is
summed by buckets of keys, in which the texts' pairs meet the models', a share of the buckets in each
of ``ROUNDS``. Beyond ``TABLE_BYTES`` segments of texts look all their keys up by a join. All three
give the same result, but for the rounding of what the rarer pairs add to single precision. A job's
shuffle files go as it ends: what is needed of it later is written.

Defined results: null and empty texts have no words and get the curve's value at no evidence;
labels that are null are ignored; of several labels of an id the toxic one counts; rows without a
label, or with a null id, are scored but not learned from; no labels of one class: nothing is known
against any text, every score is the share of toxic labels; repeated rows score alike, however long
texts are whole, and an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from snapline.llm.arrays import Words, gathered, release, row_slices, text_bytes, words_of
from snapline.llm.names import free
from snapline.session import scratch

# Discounts: most of a continuation count, most of a word (of both classes together), and of a pair.
CONTINUED, WORD, PAIR = 10_000.0, 16.0, 0.75
THRESHOLD = 0.3
# Bytes of ids, of the words' table, and of the pairs' up to which they are broadcast.
LABEL_BYTES, TABLE_BYTES, PAIR_BYTES = 64 << 20, 256 << 20, 32 << 20
# Rows up to which what the other pairs add to each text is broadcast; beyond, it is a shuffled join.
BROADCAST_ROWS = 1_000_000
# Bytes of labelled texts, or of the rarer pairs, that share a bucket; pairs that a task holds before it deals
# them to buckets: of labelled texts, whose equal pairs it adds up, and of all texts.
BUCKET_BYTES, HELD, ASKED = 4 << 20, 1 << 19, 1 << 17
# Rounds in which the rarer pairs are looked up, each of which takes its share of the disk only; bytes of texts
# whose sums share a slice.
ROUNDS, SLICE_TEXTS = 2, 16 << 20
# Rows of the scoring table that the driver fetches at once.
FETCHED = 250_000
# Bytes of texts that are scored at once: their words take some hundred times as much.
SLICE_BYTES = 1 << 19
SEGMENT_BYTES = 2 << 20

CLASSES = ("toxic", "ordinary")

CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def remainder(id_col: str, salt: str, n: int) -> Column:
    return F.crc32(F.concat(F.col(id_col).cast("string"), F.lit(salt))) % n


def _means(ratio: np.ndarray, found: Words) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(ratio)])
    return (total[found.first[1:]] - total[found.first[:-1]]) / np.maximum(found.per_row, 1)


def _less_median(ratio: np.ndarray, found: Words) -> np.ndarray:
    """Per row: the mean of its words' ratios less their median."""
    n = found.per_row
    mean = _means(ratio, found)
    row = np.repeat(np.arange(len(n)), n)
    middle = np.minimum(found.first[:-1] + n // 2, len(ratio) - 1)
    return np.where(n > 0, mean - ratio[np.lexsort((ratio, row))][middle], 0.0)


def _features(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    size = np.log1p(n) / 5
    return np.stack([np.ones(len(x)), 10 * x, size, 10 * x * size, y], axis=1)


def _fit_curve(x: np.ndarray, y: np.ndarray, n: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Logistic regression on binned evidence, with a weak pull to zero, by Newton's method."""
    features, weight = _features(x, y, n), np.zeros(5)
    pull = np.diag([0.01, 0.01, 0.1, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ weight, -30, 30)))
        slope = features.T @ ((toxic + ordinary) * p - toxic) + pull @ weight
        bend = (features * ((toxic + ordinary) * p * (1 - p))[:, None]).T @ features + pull
        step = np.linalg.solve(bend, slope)
        weight = weight - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return weight


def _keys(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its own key (even), that of the word before it (0: none), and that of the pair (odd)."""
    word = found.hashes & ~np.uint64(1)
    before = np.roll(word, 1)
    before[found.first[:-1][found.per_row > 0]] = 0
    return word, before, _pair_keys(before, word)


def _pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    pair = before * np.uint64(0x9E3779B97F4A7C15) + word * np.uint64(0xC2B2AE3D27D4EB4F)
    pair ^= pair >> np.uint64(32)
    pair *= np.uint64(0xD6E8FEB86659FD93)
    return (pair ^ (pair >> np.uint64(29))) | np.uint64(1)


def _dealt(bucket: np.ndarray, buckets: int, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row a bucket: its number, and its part of each column as bytes."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(edges))
    parts = {name: column[order] for name, column in columns.items()}
    for at in range(0, len(some), 256):
        own = some[at : at + 256]
        cut = {name: pa.array([x[edges[i] : edges[i + 1]].tobytes() for i in own], pa.binary()) for name, x in parts.items()}
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *cut.values()], names=["bucket", *cut])


def _undealt(rows: pa.Table, name: str, kind: str = "<u8") -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)


def _summed(key: np.ndarray, n: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each different key first is, by ascending keys, and the sums of its counts."""
    unique, one, place = np.unique(key, return_index=True, return_inverse=True)
    return one, [np.bincount(place, weights=x, minlength=len(unique)).astype(np.int64) for x in n]


def _pairs(labelled: DataFrame) -> DataFrame:
    """``v, w, toxic, ordinary``: occurrences of every word ``w`` after ``v`` (0: the start of a text)."""
    size = labelled.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // BUCKET_BYTES))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs = [], 0
        for batch in gathered(batches, SEGMENT_BYTES):
            data, bounds = text_bytes(batch.column(0))
            toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=bool)
            for low, high in row_slices(bounds, SEGMENT_BYTES):
                own = bounds[low : high + 1]
                found = words_of(data[own[0] : own[-1]], own - own[0])
                word, before, key = _keys(found)
                rude = np.repeat(toxic[low:high], found.per_row)
                one, n = _summed(key, [rude, ~rude])
                held.append((key[one], before[one], word[one], *n))
                pairs += len(one)
                if pairs >= HELD:
                    yield from dealt(held)
                    held, pairs = [], 0
        if pairs:
            yield from dealt(held)
        held.clear()
        release()

    def dealt(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, v, w, *n = (np.concatenate(x) for x in zip(*held))
        one, n = _summed(key, n)
        one, n = one[order := np.argsort(v[one], kind="stable")], [x[order].astype("<u4") for x in n]
        v, w = v[one], w[one]
        # A word's pairs go to sixteen buckets: some words come before a great many others.
        mixed = (v + (w >> np.uint64(60)) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        yield from _dealt((mixed >> np.uint64(32)) % np.uint64(buckets), buckets, {"v": v, "w": w, "toxic": n[0], "ordinary": n[1]})

    def added(rows: pa.Table) -> pa.Table:
        v, w = _undealt(rows, "v"), _undealt(rows, "w")
        one, n = _summed(_pair_keys(v, w), [_undealt(rows, c, "<u4") for c in CLASSES])
        order = np.argsort(v[one], kind="stable")
        columns = [v[one].view(np.int64), w[one].view(np.int64), *n]
        return pa.Table.from_arrays([pa.array(c[order]) for c in columns], names=["v", "w", *CLASSES])

    parts = labelled.mapInArrow(counted, "bucket int, v binary, w binary, toxic binary, ordinary binary")
    return parts.groupBy("bucket").applyInArrow(added, "v long, w long, toxic long, ordinary long")


def discount(n, most: float, share: float = 1.0):
    """What a word's count gives up (a number, an array or a column)."""
    most = most * share
    return n * most / (n + most)


def _table(spark, df: DataFrame, name: str) -> DataFrame:
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# Of a word: P_c(w), n_c(v) and l_c(v); of a pair, whose keys are odd, p0 and p1: what the discount left of n_c(vw).
_TABLE = "key long, p0 float, p1 float, n0 float, n1 float, l0 float, l1 float"


@dataclass
class Model:
    """The words' rows of the scoring table, counts of the pairs, the probabilities of an unknown word in either class."""

    words: DataFrame
    pairs: DataFrame
    unknown: np.ndarray

    @property
    def small(self) -> bool:
        return self.words.count() * 32 <= TABLE_BYTES

    def least(self) -> int:
        """The least count of pairs that are broadcast: as many as ``PAIR_BYTES`` hold."""
        n = F.col("toxic") + F.col("ordinary")
        found = self.pairs.groupBy(F.least(n, F.lit(1 << 12)).alias("n")).agg(F.count("*").alias("k")).collect()
        held, least = 0, (1 << 12) + 1
        for row in sorted(found, reverse=True):
            held += row.k
            if held * 16 > PAIR_BYTES:
                break
            least = row.n
        return least if held * 16 > PAIR_BYTES else 1

    def left(self, pairs: DataFrame) -> DataFrame:
        """``key, p0, p1`` of pairs: what the discount left of their counts."""

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v, w, *n = (c.to_numpy() for c in batch.columns)
                left = [pa.array(np.maximum(x - PAIR, 0), pa.float32()) for x in n]
                key = _pair_keys(v.view(np.uint64), w.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *left], names=["key", "p0", "p1"])

        return pairs.select("v", "w", *CLASSES).mapInArrow(keyed, "key long, p0 float, p1 float")


def _model(sample: DataFrame) -> Model | None:
    """From ``text, toxic``; None if a class has no word."""
    spark = sample.sparkSession
    pairs = _table(spark, _pairs(sample), "pairs")
    total = np.array([x or 0 for x in pairs.agg(F.sum("toxic"), F.sum("ordinary")).first()], dtype=float)
    if not total.all():
        return None
    share = (total / total.sum()).tolist()
    none, nothing = F.lit(0).cast("long"), F.lit(0.0)
    given = [F.least(F.col(c), F.lit(PAIR)).cast("double") for c in CLASSES]
    names = ("key", "t", "o", "k", "n0", "n1", "m0", "m1")
    following = pairs.select("w", "toxic", "ordinary", F.lit(1).cast("long"), none, none, nothing, nothing).toDF(*names)
    leading = pairs.select("v", none, none, none, "toxic", "ordinary", *given).toDF(*names)
    words = _table(spark, following.union(leading).groupBy("key").agg(*[F.sum(n).alias(n) for n in names[1:]]), "words")
    kept = lambda n, *by: F.when(n > 0, discount(n, *by)).otherwise(0.0)
    off = [kept(F.col(c), WORD, s) for c, s in zip(("t", "o"), share)]
    k, off_k = F.col("k"), kept(F.col("k"), CONTINUED)
    lost0, lost1, continued, lost_k, known = (
        float(x) for x in words.agg(F.sum(off[0]), F.sum(off[1]), F.sum(k), F.sum(off_k), F.count_if(k > 0)).first()
    )
    rest = lost_k / continued / (known + 1)
    q = (k - off_k) / continued + rest
    p = [(F.col(c) - d) / n + lost / n * q for c, d, n, lost in zip(("t", "o"), off, total.tolist(), (lost0, lost1))]
    after = [F.when(F.col(n) > 0, F.col(m) / F.col(n)).otherwise(1.0) for n, m in (("n0", "m0"), ("n1", "m1"))]
    rows = words.select("key", *p, "n0", "n1", *after)
    schema = [f.split() for f in _TABLE.split(", ")]
    rows = rows.toDF(*[n for n, _ in schema]).select(*[F.col(n).cast(kind) for n, kind in schema])
    return Model(_table(spark, rows, "model"), pairs, np.array([lost0, lost1]) / total * rest)


def _packed(x: np.ndarray) -> tuple:
    """Compressed, first bytes of all numbers together, then the second ones."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T
    return x.dtype.str, x.shape, pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(kind: str, shape: tuple, packed: bytes) -> np.ndarray:
    item, n = np.dtype(kind).itemsize, int(np.prod(shape))
    planes = np.frombuffer(pa.decompress(packed, item * n, "zstd", asbytes=True), np.uint8).reshape(item, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(shape)


@dataclass
class Table:
    """Rows of the scoring table by ascending key, words and pairs apart."""

    word: np.ndarray
    values: np.ndarray  # 6 x words
    pair: np.ndarray
    left: np.ndarray  # 2 x pairs
    unknown: np.ndarray

    def __getstate__(self) -> tuple:
        """Less than half of it is broadcast: the differences of the keys, and few different counts."""
        keys = [np.diff(x, prepend=np.int64(0)) for x in (self.word, self.pair)]
        return *(_packed(x) for x in (keys[0], self.values, keys[1], self.left)), self.unknown

    def __setstate__(self, state: tuple) -> None:
        word, self.values, pair, self.left = (_unpacked(*x) for x in state[:4])
        self.word, self.pair, self.unknown = np.cumsum(word), np.cumsum(pair), state[4]

    def ratios(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratio of each word, and what the word before it adds."""
        word, before, pair = _keys(found)
        own, place = np.unique(np.append(word, np.uint64(0)).view(np.int64), return_inverse=True)
        of = _looked_up(own, self.word, self.values, self._base)
        w = place[:-1]
        v = np.roll(w, 1)
        v[found.first[:-1][found.per_row > 0]] = place[-1]
        alone = of[:2, w]
        p = of[4:, v] * alone
        hit = np.flatnonzero(_held(pair.view(np.int64), self.pair))
        left = self.left[:, np.searchsorted(self.pair, pair[hit].view(np.int64))].astype(float)
        p[:, hit] += left / np.maximum(of[2:4, v[hit]], 1)
        single = np.log(alone[0] / alone[1])
        return single, np.log(p[0] / p[1]) - single

    def added(self, v: np.ndarray, w: np.ndarray, n: list[np.ndarray]) -> np.ndarray:
        """What pairs with these counts add to the log-likelihood ratio beyond their words."""
        of, before = (_looked_up(x, self.word, self.values, self._base) for x in (w, v))
        p = before[4:] * of[:2]
        more = p + np.maximum(np.array(n) - PAIR, 0).astype(np.float32) / np.maximum(before[2:4], 1)
        return (np.log(more[0] / more[1]) - np.log(p[0] / p[1])).astype(np.float64)

    def open(self, found: Words, asked: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the pairs of known words, of those that are ``asked`` for, that are not in this table."""
        word, before, pair = _keys(found)
        own, place = np.unique(np.append(word, np.uint64(0)).view(np.int64), return_inverse=True)
        known = _held(own, self.word)
        v = np.roll(place[:-1], 1)
        v[found.first[:-1][found.per_row > 0]] = place[-1]
        at = np.flatnonzero(known[place[:-1]] & known[v] & asked(pair))
        at = at[~_held(pair[at].view(np.int64), self.pair)]
        return at, pair[at]

    @property
    def _base(self) -> np.ndarray:
        return np.array([*self.unknown, 0, 0, 1, 1])[:, None]

    def evidence(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: the evidence of words and of pairs, and the number of words."""
        x, y, n = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1, np.int64)
        for low, high in row_slices(bounds, SLICE_BYTES):
            own = bounds[low : high + 1]
            found = words_of(data[own[0] : own[-1]], own - own[0])
            if len(found.hashes):
                single, more = self.ratios(found)
                x[low:high] = _less_median(single, found)
                y[low:high] = _means(more, found)
            n[low:high] = found.per_row
        return x, y, n


def table_of(words: Iterable[pa.Table], pairs: Iterable[pa.Table], unknown: np.ndarray) -> Table:
    """From rows by ascending keys, in slices: the least is held beside the arrays that are made."""
    own = []
    for slices, n in ((words, 6), (pairs, 2)):
        parts = [(rows.column(0).to_numpy(), np.array([rows.column(i).to_numpy() for i in range(1, n + 1)], np.float32)) for rows in slices]
        own += [np.concatenate([key for key, _ in parts]), np.concatenate([values for _, values in parts], axis=1)]
    return Table(*own, unknown)


def fetched(rows: DataFrame) -> Iterator[pa.Table]:
    """Rows by ascending keys, fetched a range of keys after another: these are hashes, so ranges are alike."""
    n = max(1, -(-rows.count() // FETCHED))
    edges = [-(1 << 63) + ((1 << 64) * i // n) for i in range(n)]
    for low, high in zip(edges, [*edges[1:], None]):
        part = rows.where(F.col("key") >= low)
        yield (part if high is None else part.where(F.col("key") < high)).orderBy("key").toArrow()


def broadcast_table(model: Model, least: int = 1) -> Table:
    """Of all words, and of pairs that are at least so frequent."""
    frequent = _table(model.pairs.sparkSession, model.left(model.pairs.where(F.col("toxic") + F.col("ordinary") >= least)), "frequent")
    return table_of(fetched(model.words), fetched(frequent), model.unknown)


def _held(wanted: np.ndarray, key: np.ndarray) -> np.ndarray:
    if not len(key):
        return np.zeros(len(wanted), bool)
    return key[np.minimum(np.searchsorted(key, wanted), len(key) - 1)] == wanted


def _looked_up(wanted: np.ndarray, key: np.ndarray, values: np.ndarray, missing: np.ndarray) -> np.ndarray:
    wanted = wanted.view(np.int64)  # as Spark orders them
    if not len(key):
        return np.broadcast_to(missing, (len(values), len(wanted))).astype(float)
    place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
    return np.where(key[place] == wanted, values[:, place], missing)


def _segments(docs: DataFrame, text_col: str, columns: list[str], path: str) -> DataFrame:
    """Write and read ``segment, rows, bounds, text``: the texts of some MB, compressed, with ``columns`` of each."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SEGMENT_BYTES):
            data, bounds = text_bytes(batch.column(0))
            for low, high in row_slices(bounds, SEGMENT_BYTES):
                own = bounds[low : high + 1]
                raw = data[own[0] : own[-1]].tobytes()
                rows = batch.column(1).slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uuid.uuid4().int >> 66], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                        pa.array([(own - own[0]).astype("<i8").tobytes()], pa.binary()),
                        pa.array([pa.compress(raw, "zstd", asbytes=True)], pa.binary()),
                    ],
                    names=["segment", "rows", "bounds", "text"],
                )

    whole = docs.select(text_col, F.struct(*[f"`{c}`" for c in columns]).alias("row"))
    schema = StructType([
        StructField("segment", LongType()), StructField("rows", ArrayType(whole.schema["row"].dataType)),
        StructField("bounds", BinaryType()), StructField("text", BinaryType()),
    ])
    whole.mapInArrow(segments, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _words(bounds: bytes, text: bytes) -> Words:
    bounds = np.frombuffer(bounds, "<i8")
    return words_of(np.frombuffer(pa.decompress(text, int(bounds[-1]), "zstd", asbytes=True), np.uint8), bounds)


def _joined(docs: DataFrame, text_col: str, columns: list[str], model: Model, schema: StructType) -> DataFrame:
    """The evidence by a join of the keys of each segment of texts with the scoring table."""
    segments, unknown = _segments(docs, text_col, columns, scratch(docs.sparkSession, "segments")), model.unknown

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, bounds, text in zip(*(c.to_pylist() for c in batch.columns)):
                word, _, pair = _keys(_words(bounds, text))
                key = np.unique(np.concatenate([word, pair, np.zeros(1, np.uint64)]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), segment)), pa.array(key.view(np.int64))], names=["segment", "wanted"])

    asked = segments.select("segment", "bounds", "text").mapInArrow(wanted, "segment long, wanted long")
    rows = model.words.unionByName(model.left(model.pairs), allowMissingColumns=True).na.fill(0.0)
    found = asked.join(rows, F.col("wanted") == F.col("key")).select("segment", *rows.columns)

    def scored(texts: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["segment"]).sort_by("key")
        odd = pc.bit_wise_and(rows.column("key"), 1)
        table = table_of([rows.filter(pc.equal(odd, 0))], [rows.filter(pc.equal(odd, 1))], unknown)
        made = []
        for at in range(len(texts)):
            bounds = np.frombuffer(texts.column("bounds")[at].as_py(), "<i8")
            raw = pa.decompress(texts.column("text")[at].as_py(), int(bounds[-1]), "zstd", asbytes=True)
            found = table.evidence(np.frombuffer(raw, np.uint8), bounds)
            own = texts.column("rows")[at].values
            made.append(pa.Table.from_arrays([*(own.field(i) for i in range(len(columns))), *map(pa.array, found)], names=schema.fieldNames()))
        return pa.concat_tables(made)

    return segments.groupBy("segment").cogroup(found.groupBy("segment")).applyInArrow(scored, schema)


def _words(bounds: bytes, text: bytes) -> Words:
    own = np.frombuffer(bounds, "<i8")
    return words_of(np.frombuffer(pa.decompress(text, int(own[-1]), "zstd", asbytes=True), np.uint8), own)


class _Rest:
    """What pairs add that are too rare for the broadcast table: keys of texts and of pairs meet in buckets."""

    def __init__(self, model: Model, shared, least: int):
        self.pairs = model.pairs.where(F.col("toxic") + F.col("ordinary") < least).select("v", "w", *CLASSES)
        self.shared, self.rounds, self.buckets = shared, ROUNDS, max(1, -(-model.pairs.count() * 16 // BUCKET_BYTES))

    def rare(self, turn: int) -> DataFrame:
        """``bucket, key, more`` of the pairs of a round: what each adds."""
        shared, buckets, rounds = self.shared, self.buckets, self.rounds

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches, SEGMENT_BYTES):
                v, w, *n = (c.to_numpy() for c in batch.columns)
                v, w = v.view(np.uint64), w.view(np.uint64)
                own = np.flatnonzero(_turn(_pair_keys(v, w), buckets, rounds) == turn)
                v, w = v[own], w[own]
                key, more = _pair_keys(v, w), shared.value.added(v, w, [x[own] for x in n]).astype("<f4")
                yield from _dealt(_bucket(key, buckets), buckets, {"key": key, "more": more})

        return self.pairs.mapInArrow(dealt, "bucket int, key binary, more binary")

    def sums(self, texts: DataFrame, turn: int, slices: int) -> DataFrame:
        """``digest, more`` of ``text, digest``: the sum over the pairs of a round of all texts with this digest."""
        shared, buckets, rounds = self.shared, self.buckets, self.rounds

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, pairs = [], 0
            for batch in batches:
                data, bounds = text_bytes(batch.column(0))
                digest = batch.column(1).to_numpy()
                for low, high in row_slices(bounds, SLICE_BYTES):
                    own = bounds[low : high + 1]
                    found = words_of(data[own[0] : own[-1]], own - own[0])
                    if not len(found.hashes):
                        continue
                    at, key = shared.value.open(found, lambda pair: _turn(pair, buckets, rounds) == turn)
                    held.append((key, np.repeat(digest[low:high], found.per_row)[at]))
                    pairs += len(key)
                    if pairs >= ASKED:
                        yield from dealt(held)
                        held, pairs = [], 0
            if pairs:
                yield from dealt(held)
            held.clear()
            release()

        def dealt(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            key, digest = (np.concatenate(x) for x in zip(*held))
            yield from _dealt(_bucket(key, buckets), buckets, {"key": key, "digest": digest})

        def met(texts: pa.Table, pairs: pa.Table) -> pa.Table:
            key, more = _undealt(pairs, "key").view(np.int64), _undealt(pairs, "more", "<f4")
            order = np.argsort(key)
            wanted, digest = _undealt(texts, "key"), _undealt(texts, "digest", "<i8")
            found = _looked_up(wanted, key[order], more[order][None], np.zeros((1, 1)))[0]
            hit = np.flatnonzero(found)
            digest, total = _added_up(digest[hit], found[hit])
            # Packed by slices of the digests: a row for each text and bucket would be far more.
            slice_of = (digest.view(np.uint64) >> np.uint64(32)) % np.uint64(slices)
            made = list(_dealt(slice_of, slices, {"digest": digest, "more": total}))
            return pa.Table.from_batches(made, packed).rename_columns(["slice", "digest", "more"])

        def summed(rows: pa.Table) -> pa.Table:
            own = _added_up(_undealt(rows, "digest", "<i8"), _undealt(rows, "more", "<f8"))
            return pa.Table.from_arrays([pa.array(x) for x in own], names=["digest", "more"])

        packed = pa.schema([("bucket", pa.int32()), ("digest", pa.binary()), ("more", pa.binary())])
        keys = texts.mapInArrow(asked, "bucket int, key binary, digest binary")
        made = keys.groupBy("bucket").cogroup(self.rare(turn).groupBy("bucket")).applyInArrow(met, "slice int, digest binary, more binary")
        return made.groupBy("slice").applyInArrow(summed, "digest long, more double")

    def add(self, plain: Callable, docs: DataFrame, text_col: str, columns: list[str], names: tuple[str, str, str]) -> DataFrame:
        """``plain`` evidence of the frequent pairs, and that of the others; equal texts have it in common."""
        spark, (x, y, n) = docs.sparkSession, names
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        digest = F.xxhash64(text)
        copies = docs.groupBy(digest.alias("digest")).agg(F.count("*").alias("copies"), F.sum(F.octet_length(text)).alias("size"))
        copies = _table(spark, copies, "copies")
        slices = max(1, -(-(copies.agg(F.sum("size")).first()[0] or 0) // SLICE_TEXTS))
        texts = docs.select(text.alias("text"), digest.alias("digest"))
        sums = [_table(spark, self.sums(texts, turn, slices), "sums") for turn in range(self.rounds)]
        whole = reduce(DataFrame.union, sums).groupBy("digest").agg(F.sum("more").alias("more"))
        each = _table(spark, whole.join(copies, "digest").select("digest", (F.col("more") / F.col("copies")).alias("more")), "rest")
        mark, of, more = (free([*docs.columns, *names], name) for name in ("text_digest", "of_digest", "rest"))
        each = each.toDF(of, more)
        whole = plain(docs.withColumn(mark, digest), text_col, [*columns, mark])
        joined = whole.join(F.broadcast(each) if each.count() <= BROADCAST_ROWS else each, F.col(mark) == F.col(of), "left")
        total = F.col(y) + F.coalesce(F.col(more) / F.greatest(F.col(n), F.lit(1)), F.lit(0.0))
        return joined.select(*[f"`{c}`" for c in columns], x, total.alias(y), n)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (key >> np.uint64(32)) % np.uint64(buckets)


def _turn(key: np.ndarray, buckets: int, rounds: int) -> np.ndarray:
    """The round in which the key's bucket is looked up."""
    return _bucket(key, buckets) % np.uint64(rounds)


def _added_up(digest: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(digest, return_inverse=True)
    return unique, np.bincount(place, weights=more, minlength=len(unique))


def _with_evidence(model: Model, names: tuple[str, str, str]) -> Callable[[DataFrame, str, list[str]], DataFrame]:
    """What adds the evidence of words and of pairs and the number of words to ``columns`` of a frame."""

    def widened(docs: DataFrame, columns: list[str]) -> StructType:
        schema = docs.select(*[f"`{c}`" for c in columns]).schema
        for name, kind in zip(names, ("double", "double", "long")):
            schema = schema.add(name, kind)
        return schema

    if not model.small:
        return lambda docs, text_col, columns: _joined(docs, text_col, columns, model, widened(docs, columns))
    least = model.least()
    shared = model.words.sparkSession.sparkContext.broadcast(broadcast_table(model, least))
    pa.default_memory_pool().release_unused()
    rest = None if least == 1 else _Rest(model, shared, least)

    def add(docs: DataFrame, text_col: str, columns: list[str]) -> DataFrame:
        if rest is not None:
            return rest.add(plain, docs, text_col, columns, names)
        return plain(docs, text_col, columns)

    def plain(docs: DataFrame, text_col: str, columns: list[str]) -> DataFrame:
        inner = docs.select(*[f"`{c}`" for c in columns], *([] if text_col in columns else [f"`{text_col}`"]))
        at, kept = inner.columns.index(text_col), len(columns)
        schema = widened(docs, columns)

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = shared.value.evidence(*text_bytes(batch.column(at)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *map(pa.array, own)], names=schema.fieldNames())
                release()

        return inner.mapInArrow(scored, schema)

    return add


def _score(curve: np.ndarray, x: str, y: str, n: str) -> Column:
    z, size = 10 * F.col(x), F.log1p(n) / 5
    total = sum(float(weight) * f for weight, f in zip(curve[1:], (z, size, z * size, F.col(y)))) + float(curve[0])
    return 1 / (1 + F.exp(-F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0))))


def _drawn(labels: DataFrame, learn: Column, id_col: str, rows: int | None = None) -> DataFrame:
    """``id_col, toxic``: all labelled ids that may be learned from, or about ``rows`` of them."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & learn).groupBy(id_col).agg((F.max("toxic") > 0).alias("toxic"))
    if rows is not None:
        share = min(1.0, rows / max(known.count(), 1))
        known = known.where(F.pmod(F.xxhash64(id_col, F.lit("fit")), F.lit(1 << 20)) < int(share * (1 << 20)))
    return _table(labels.sparkSession, known, "labels")


def scores(
    docs: DataFrame, labels: DataFrame, learn: Column, columns: list[str], score: str = "score", id_col: str = "doc_id",
    text_col: str = "text", rows: int | None = None,
) -> DataFrame:
    """``columns`` and ``score`` per row, by models from rows of ``docs`` whose ids ``labels`` knows and for
    which ``learn``, a test of the id, holds; a caller may have it learn from about ``rows`` ids only."""
    docs.sparkSession.conf.set(CLEANED, "true")
    known = _drawn(labels, learn, id_col, rows)
    size = known.agg(F.coalesce(F.sum(F.length(F.col(id_col).cast("string")) + 16), F.lit(0))).first()[0]
    small = size <= LABEL_BYTES
    kept = docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(known) if small else known, id_col)
    fits = F.coalesce(remainder(id_col, ":curve", 5) == 0, F.lit(False))
    sample = kept.select("text", "toxic", fits.alias("fits"))
    sample = sample if small else _table(docs.sparkSession, sample, "labelled")  # without a shuffle rather read twice
    share = float(sample.agg(F.coalesce(F.avg(F.col("toxic").cast("int")), F.lit(0.0))).first()[0])
    whole = [f"`{c}`" for c in columns]
    model = _model(sample.where("not fits").select("text", "toxic"))
    if model is None:
        return docs.select(*whole, F.lit(share).alias(score))
    names = tuple(free(docs.columns, name) for name in ("single", "more", "words"))
    x, y, n = names
    add = _with_evidence(model, names)
    bins = [F.rint(F.least(F.greatest(c, F.lit(-8.0)), F.lit(8.0)) * 500).alias(name) for c, name in ((x, "x"), (y, "y"))]
    bins.append(F.rint(F.log2(F.col(n) + 1) * 2).alias("n"))
    binned = add(sample.where("fits"), "text", ["toxic"]).groupBy(*bins)
    found = binned.agg(F.sum(F.col("toxic").cast("int")).alias("t"), F.count("*").alias("all")).collect()
    if found:
        single, more, size, t, every = np.array([[r[c] for c in ("x", "y", "n", "t", "all")] for r in found], dtype=np.float64).T
        curve = _fit_curve(single / 500, more / 500, 2 ** (size / 2) - 1, t, every - t)
    else:
        curve = np.array([np.log((share + 1e-6) / (1 - share + 1e-6)), 1.0, 0.0, 0.0, 0.0])
    return add(docs, text_col, columns).select(*whole, _score(curve, *names).alias(score))


def _learned(id_col: str) -> Column:
    """Ids that labels are learned of: the CRC-32 does not leave 2 modulo 4."""
    return F.coalesce(remainder(id_col, "", 4) != 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", threshold: float = THRESHOLD, rows: int | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted``; rows whose id's CRC-32 leaves 2 modulo 4 are held out."""
    scored = scores(docs, labels, _learned(id_col), [id_col], id_col=id_col, rows=rows)
    held_out = F.coalesce(remainder(id_col, "", 4) == 2, F.lit(False))
    return scored.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", threshold: float = THRESHOLD, rows: int | None = None) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    score = free(docs.columns, "score")
    scored = scores(docs, labels, _learned(id_col), docs.columns, score, id_col, rows=rows)
    return scored.where(F.col(score) < threshold).select(*[f"`{c}`" for c in docs.columns])
