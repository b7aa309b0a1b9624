"""Language identification: multinomial naive Bayes over hashed character n-grams.

Spark sums the n-gram counts of all labelled texts; the log-probabilities, one row per hash bucket
and one column per language, are broadcast in blocks of ``BLOCK`` languages, so the size of each is
fixed however many languages the labels name, and a language's row of buckets does not depend on how
many there are. Texts are scored in batches, block after block: a sparse sum of matrix rows.
Characters other than letters look alike, case is ignored.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every
text where nothing could be learned; null labels and ids are not learned from; a null id is not held
out; equal scores go to the first language by name; repeated rows are separate documents; texts of
any length are scored whole; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapline.llm.arrays import PIECE, hash_spans, row_slices, text_bytes
from snapline.session import scratch

GRAMS = (1, 2, 3)
BUCKETS = 1 << 16
BLOCK = 64
SMOOTHING = 0.1
UNKNOWN = "und"
# Languages whose counts a task holds before it passes them on.
HELD = 32


def _folded() -> np.ndarray:
    """A random number per byte; ASCII other than letters shares one, A-Z and a-z agree."""
    code = np.arange(256)
    code = np.where((code >= 65) & (code <= 90), code + 32, code)
    code = np.where((code < 97) | ((code > 122) & (code < 128)), 32, code)
    return np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)[code]


_VALUE = _folded()


def grams(data: np.ndarray, bounds: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all n-grams of whole texts, a piece of the bytes at a time."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # where a character begins
    last = np.searchsorted(heads, bounds[1:], "left")  # characters up to the end of each row
    step = PIECE // 2
    for low in range(0, len(data), step):
        first, stop = np.searchsorted(heads, [low, min(low + step, len(data))])
        if first == stop:
            continue
        row = np.searchsorted(bounds, heads[first:stop], "right") - 1
        part = data[low : low + step + 4 * max(GRAMS)]
        ends = np.append(heads, len(data))
        char = np.arange(first, stop)
        for n in GRAMS:
            whole = char + n <= last[row]
            at = char[whole]
            yield row[whole], (hash_spans(part, heads[at] - low, ends[at + n] - low, _VALUE) >> shift).astype(np.int64)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _counts(labelled: DataFrame, buckets: int) -> DataFrame:
    """``lang, bucket, n`` of the labelled texts."""

    def rows(counts: dict) -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            bucket = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bucket)), pa.array(bucket.astype(np.int32)), pa.array(n[bucket])], names=["lang", "bucket", "n"]
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            code = batch.column(1).dictionary_encode()
            index, names = code.indices.to_numpy(), code.dictionary.to_pylist()
            for low, high in row_slices(bounds, PIECE):
                own = bounds[low : high + 1]
                lang = index[low:high].astype(np.int64)
                for row, bucket in grams(data[own[0] : own[-1]], own - own[0], buckets):
                    for k in np.unique(lang[row]):
                        mine = np.bincount(bucket[lang[row] == k], minlength=buckets)
                        held[names[k]] = held[names[k]] + mine if names[k] in held else mine
                if len(held) > HELD:
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    return labelled.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text", block: int = BLOCK) -> list[tuple[list[str], np.ndarray]]:
    """Blocks of languages in order, and per bucket their log-probabilities; the last row holds the priors."""
    labelled = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    share = {r["lang"]: r["n"] for r in labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    langs = sorted(share)
    counts = _counts(labelled.select(F.lower(text_col), F.col(lang_col).alias("lang")), BUCKETS)
    if len(langs) > block:
        path = scratch(docs.sparkSession, "grams")
        counts.write.parquet(path)
        counts = docs.sparkSession.read.parquet(path)
    made = []
    for low in range(0, len(langs), block):
        own = langs[low : low + block]
        found = (counts.where(F.col("lang").isin(own)) if len(langs) > block else counts).toArrow()
        n, place = np.zeros((BUCKETS, len(own))), {lang: i for i, lang in enumerate(own)}
        column = np.array([place[x] for x in found.column("lang").to_pylist()], dtype=np.int64)
        n[found.column("bucket").to_numpy(), column] = found.column("n").to_numpy()
        matrix = np.log(n + SMOOTHING) - np.log(n.sum(axis=0) + SMOOTHING * BUCKETS)
        prior = np.log(np.array([share[x] for x in own], dtype=np.float64)) - np.log(max(1, sum(share.values())))
        made.append((own, np.vstack([matrix, prior[None, :]]).astype(np.float32)))
    return made


def _likelihoods(data: np.ndarray, bounds: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Of each text in each language of the block."""
    weights, log = matrix[:-1], np.tile(matrix[-1].astype(np.float64), (len(bounds) - 1, 1))
    for low, high in row_slices(bounds, PIECE):
        own = bounds[low : high + 1]
        for row, bucket in grams(data[own[0] : own[-1]], own - own[0], len(weights)):
            for k in range(weights.shape[1]):
                log[low:high, k] += np.bincount(row, weights=weights[bucket, k], minlength=high - low)
    return log


# The best language so far, its log-likelihood, and the sum of all relative to it.
_STATE = (("lang_pred", "string"), ("log", "double"), ("total", "double"))


def _scored(rows: DataFrame, langs: list[str], matrix: np.ndarray, fresh: bool) -> DataFrame:
    """``rows`` (text, columns, then the state unless ``fresh``) with the state after a block of languages."""
    schema = StructType(rows.schema.fields[: len(rows.columns) - (0 if fresh else len(_STATE))])
    width = len(schema)
    for name, kind in _STATE:
        schema = schema.add(name, kind)
    shared = rows.sparkSession.sparkContext.broadcast(matrix)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(langs, dtype=object)
        for batch in batches:
            log = _likelihoods(*text_bytes(batch.column(0)), shared.value)
            best, top = names[log.argmax(axis=1)], log.max(axis=1)
            total = np.exp(log - top[:, None]).sum(axis=1)
            if not fresh:
                before, old, rest = (batch.column(width + i).to_numpy(zero_copy_only=False) for i in range(3))
                both = np.maximum(old, top)
                total = total * np.exp(top - both) + rest * np.exp(old - both)
                best, top = np.where(top > old, best, before), both
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(best, pa.string()), pa.array(top), pa.array(total)], names=schema.fieldNames())

    return rows.mapInArrow(scored, schema)


def identify(docs: DataFrame, blocks: list[tuple[list[str], np.ndarray]], columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns, lang_pred, score`` (the posterior probability of the prediction)."""
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if not blocks:
        return docs.select(*columns, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(F.lower(text_col).alias("__text"), letters.alias("__letters"), *columns)
    for at, (langs, matrix) in enumerate(blocks):
        rows = _scored(rows, langs, matrix, at == 0)
    known = lambda value, other: F.when(F.col("__letters"), value).otherwise(other)
    return rows.select(*columns, known(F.col("lang_pred"), UNKNOWN).alias("lang_pred"), known(1 / F.col("total"), 0.0).alias("score"))


def languages(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows whose id's CRC-32 leaves 1 modulo 3 are held out."""
    apart = held_out(id_col)
    blocks = train(docs, ~apart & F.col(id_col).isNotNull(), lang_col, text_col)
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"), apart.alias("held_out"))
    return identify(rows, blocks, ["doc_id", "held_out"])
