"""Benchmark decontamination with a distributed positional inverted index.

The index is split by documents. A row of it is a segment: the postings (term, word positions)
of about a million words, so a term that fills a third of all texts is many bounded lists. Building
and reading it needs no shuffle, only the corpus frequencies of the benchmark's terms are summed.
Test windows go to the segments in blocks of bounded size; within a segment the
position lists of a window's terms are shifted by their offsets and intersected, rarest term first.

Defined results: null or empty texts have no words; repeated rows are separate documents; a null
item id counts as the empty id; an empty benchmark hits nothing and an empty table gives an empty one;
very long texts are indexed whole; there are no ties to break; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.llm.arrays import Words, gathered, ragged, row_slices, text_bytes, words_of
from snapline.llm.names import free
from snapline.session import scratch

SEGMENT_BYTES = 6 << 20
# Size bounds of what is broadcast: a block of windows, and the vocabulary that prunes the index.
BLOCK_WINDOWS = 100_000
VOCABULARY = 4_000_000
# Candidates that one step of an intersection holds.
STEP = 2_000_000

_SEGMENT = "segment long, ids array<string>, words array<int>, terms array<long>, counts array<int>, positions binary"
_MATCH = "segment long, doc int, items array<string>, spans array<struct<start:int,stop:int>>"


def _lists(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


def build_index(docs: DataFrame, path: str, id_col: str, text_col: str = "text", vocabulary: np.ndarray | None = None) -> DataFrame:
    """Write the postings of ``docs`` below ``path``; with ``vocabulary`` (sorted hashes) only of its terms."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def segment(ids: pa.Array, words: Words) -> pa.RecordBatch:
        terms, position = words.hashes, np.arange(len(words.hashes), dtype=np.int32)
        if known.value is not None:
            place = np.searchsorted(known.value, terms)
            place[place == len(known.value)] = 0
            held = known.value[place] == terms if len(known.value) else np.zeros(len(terms), bool)
            terms, position = terms[held], position[held]
        order = np.argsort(terms, kind="stable")
        unique, counts = np.unique(terms[order], return_counts=True)
        ends = lambda column: np.array([0, len(column)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().int >> 66], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends(ids), pa.int32()), ids),
                _lists(words.per_row.astype(np.int32), ends(words.per_row)),
                _lists(unique.view(np.int64), ends(unique)),
                _lists(counts.astype(np.int32), ends(counts)),
                pa.array([position[order].tobytes()], pa.binary()),
            ],
            names=["segment", "ids", "words", "terms", "counts", "positions"],
        )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SEGMENT_BYTES):
            ids = batch.column(0)
            data, bounds = text_bytes(batch.column(1))
            for low, high in row_slices(bounds, SEGMENT_BYTES):
                own = bounds[low : high + 1]
                yield segment(ids.slice(low, high - low), words_of(data[own[0] : own[-1]], own - own[0]))

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    rows.mapInArrow(segments, _SEGMENT).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def item_windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, terms``: each run of ``size`` words of an item; a shorter item is one window."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            words = words_of(data, bounds)
            length = words.per_row
            item, start = ragged(words.first[:-1], np.where(length > 0, np.maximum(1, length - size + 1), 0))
            width = np.minimum(size, length)[item]
            _, place = ragged(start, width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(item)), _lists(words.hashes.view(np.int64)[place], np.concatenate([[0], np.cumsum(width)]))],
                names=["item", "terms"],
            )

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    return rows.mapInArrow(windows, "item string, terms array<long>").distinct()


class _Segment:
    """Position lists of one segment, looked up by term."""

    def __init__(self, row: dict, terms: np.ndarray):
        own = np.asarray(row["terms"], dtype=np.int64).view(np.uint64)
        self.counts = np.asarray(row["counts"], dtype=np.int64)
        self.positions = np.frombuffer(row["positions"], dtype=np.int32)
        self.first = np.cumsum(self.counts) - self.counts
        self.words = np.asarray(row["words"], dtype=np.int64)
        self.doc_first = np.concatenate([[0], np.cumsum(self.words)])
        self.n = int(self.doc_first[-1])
        place = np.minimum(np.searchsorted(own, terms), max(len(own) - 1, 0))
        self.list_of = np.where(own[place] == terms, place, -1) if len(own) else np.full(len(terms), -1)
        # The lists turned round: the term at each position, so that a shifted list is met by one lookup.
        self.at = np.full(self.n, -1, dtype=np.int32)
        self.at[self.positions] = np.repeat(np.arange(len(own), dtype=np.int32), self.counts)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_first, position, side="right") - 1


class Queries:
    """A block of test windows with their terms ordered from the rarest."""

    def __init__(self, items: list[str], windows: list[list[int]], frequency: dict[int, int]):
        self.items = items
        self.width = np.array([len(w) for w in windows], dtype=np.int64)
        widest = int(self.width.max(initial=1))
        flat = np.array([t for w in windows for t in w], dtype=np.int64).view(np.uint64)
        self.terms, place = np.unique(flat, return_inverse=True)
        rarity = np.array([frequency.get(int(t), 0) for t in self.terms.view(np.int64)], dtype=np.int64)
        self.term = np.zeros((len(windows), widest), dtype=np.int64)
        self.offset = np.zeros((len(windows), widest), dtype=np.int64)
        owner, within = ragged(np.zeros(len(windows), np.int64), self.width)
        order = np.lexsort((within, rarity[place], owner))
        self.term[owner, within], self.offset[owner, within] = place[order], within[order]

    def phrases(self, row: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) of every exact occurrence in a segment."""
        segment = _Segment(row, self.terms)
        found = segment.list_of[self.term] if len(self.terms) else np.full(self.term.shape, -1)
        used = np.arange(self.term.shape[1]) < self.width[:, None]
        alive = np.flatnonzero((found >= 0).all(axis=1, where=used))
        lead = found[alive, 0]
        load = segment.counts[lead]
        for low, high in row_slices(np.concatenate([[0], np.cumsum(load)]), STEP):
            owner, place = ragged(segment.first[lead[low:high]], load[low:high])
            window = alive[low:high][owner]
            start = segment.positions[place].astype(np.int64) - self.offset[window, 0]
            kept = (start >= 0) & (start + self.width[window] <= segment.n)
            window, start = window[kept], start[kept]
            for j in range(1, self.term.shape[1]):
                need = j < self.width[window]
                hit = segment.at[np.where(need, start + self.offset[window, j], 0)] == found[window, j]
                kept = hit | ~need
                window, start = window[kept], start[kept]
            kept = segment.doc_of(start) == segment.doc_of(start + self.width[window] - 1)
            yield window[kept], start[kept]

    def near(self, row: dict, within: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, position of its rarest term) where every other term of the window occurs
        in the same document at most ``within`` words away."""
        segment = _Segment(row, self.terms)
        for window in range(len(self.width)):
            lists = [int(segment.list_of[t]) for t in self.term[window, : self.width[window]]]
            if min(lists) < 0:
                continue
            spans = [segment.positions[segment.first[k] : segment.first[k] + segment.counts[k]].astype(np.int64) for k in lists]
            at = spans[0]
            for other in spans[1:]:
                doc = segment.doc_of(at)
                place = np.searchsorted(other, at)
                ok = np.zeros(len(at), bool)
                for side in (np.maximum(place - 1, 0), np.minimum(place, len(other) - 1)):
                    ok |= (np.abs(other[side] - at) <= within) & (segment.doc_of(other[side]) == doc)
                at = at[ok]
            yield np.full(len(at), window), at


def _blocks(index: DataFrame, windows: DataFrame) -> Iterator[Queries]:
    """The windows in blocks small enough to broadcast, ordered by the index's own frequencies."""
    spark = index.sparkSession
    n_blocks = -(-windows.count() // BLOCK_WINDOWS)
    # By item too: a window that many items share would fill one block.
    windows = windows.withColumn("block", F.pmod(F.xxhash64("item", "terms"), F.lit(max(1, n_blocks))))
    frequency = (
        index.select(F.inline(F.arrays_zip("terms", "counts")))
        .groupBy("terms").agg(F.sum("counts").alias("n"))
        .join(windows.select(F.explode("terms").alias("terms")).distinct(), "terms", "left_semi")
    )
    if n_blocks > 1:  # each block reads it again
        path = scratch(spark, "frequency")
        frequency.write.parquet(path)
        frequency = spark.read.parquet(path)
    for block in range(n_blocks):
        own = windows.where(F.col("block") == block)
        terms = own.select(F.explode("terms").alias("terms")).distinct()
        known = {r["terms"]: r["n"] for r in (frequency.join(terms, "terms", "left_semi") if n_blocks > 1 else frequency).collect()}
        rows = own.select("item", "terms").collect()
        yield Queries([r["item"] for r in rows], [r["terms"] for r in rows], known)


def matches(index: DataFrame, windows: DataFrame, within: int | None = None) -> DataFrame:
    """``segment, doc, items, spans`` of documents with exact occurrences of windows, or, with
    ``within``, with all terms of a window at most so many words from its rarest one."""
    spark = index.sparkSession
    found = spark.createDataFrame([], _MATCH)
    for queries in _blocks(index, windows):
        block = spark.sparkContext.broadcast(queries)

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            queries = block.value
            for batch in batches:
                for row in batch.to_pylist():
                    hits = list(queries.phrases(row) if within is None else queries.near(row, within))
                    if not sum(len(w) for w, _ in hits):
                        continue
                    window, start = (np.concatenate(x) for x in zip(*hits))
                    first = np.concatenate([[0], np.cumsum(np.asarray(row["words"], dtype=np.int64))])
                    doc = np.searchsorted(first, start, side="right") - 1
                    width = queries.width[window] if within is None else np.ones(len(window), np.int64)
                    order = np.lexsort((start, doc))
                    doc, start, width, window = doc[order], (start - first[doc])[order], width[order], window[order]
                    cuts = np.flatnonzero(np.diff(doc, prepend=-1))
                    made = []
                    for low, high in zip(cuts, [*cuts[1:], len(doc)]):
                        made.append({
                            "segment": row["segment"], "doc": int(doc[low]),
                            "items": sorted({queries.items[w] for w in window[low:high]}),
                            "spans": _merged(start[low:high], start[low:high] + width[low:high]),
                        })
                    yield pa.RecordBatch.from_pylist(made, schema=_MATCH_ARROW)

        columns = index.select("segment", "words", "terms", "counts", "positions")
        found = found.union(columns.mapInArrow(search, _MATCH))
    return found


_MATCH_ARROW = pa.schema([
    ("segment", pa.int64()), ("doc", pa.int32()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
])


def _merged(start: np.ndarray, stop: np.ndarray) -> list[dict]:
    """Overlapping or touching spans (sorted by start) as one."""
    reach = np.maximum.accumulate(stop)
    head = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    tail = np.concatenate([head[1:], [len(start)]]) - 1
    return [{"start": int(a), "stop": int(b)} for a, b in zip(start[head], reach[tail])]


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    spark = docs.sparkSession
    windows_at = scratch(spark, "windows")
    item_windows(items, window).write.parquet(windows_at)
    windows = spark.read.parquet(windows_at)
    terms = windows.select(F.explode("terms").alias("t")).distinct()
    vocabulary = None
    if terms.count() <= VOCABULARY:
        vocabulary = np.sort(np.array([r["t"] for r in terms.collect()], dtype=np.int64).view(np.uint64))
    index = build_index(docs, scratch(spark, "index"), id_col, text_col, vocabulary)

    ordered = F.array_sort(F.flatten(F.collect_list("spans")))
    # Spans of several blocks may overlap: count each word once.
    covered = F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], a["reach"]))).cast("long").alias("n"),
            F.greatest(x["stop"], a["reach"]).alias("reach"),
        ),
        lambda a: a["n"],
    )
    hits = matches(index, windows).groupBy("segment", "doc").agg(
        covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    every = index.select("segment", F.posexplode(F.arrays_zip("ids", "words")).alias("doc", "row")).select(
        "segment", "doc", F.col("row.ids").cast(docs.schema[id_col].dataType).alias("doc_id"), F.col("row.words").cast("long").alias("n_words")
    )
    named = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(hits, ["segment", "doc"], "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(named).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents that hold an occurrence of a window; null texts stay."""
    digest = free(docs.columns, "digest")
    keyed = docs.withColumn(digest, F.md5(F.col("text")))
    bad = decontaminate(keyed.where(F.col("text").isNotNull()).select(digest, "text"), items, window, digest).where("contaminated")
    bad = bad.select(F.col("doc_id").alias(digest)).distinct()
    return keyed.join(bad, digest, "left_anti").select(*[f"`{c}`" for c in docs.columns])
