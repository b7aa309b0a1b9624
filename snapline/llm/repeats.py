"""Removal of long repeats with suffix arrays of shards.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts anywhere else. To find equal
strings in separate shards, each window is dealt by its content: its anchor (the least hashed gram
in it), and the bytes that every window with the anchor at about that place has around it. Equal
windows have the same anchor at the same place, so they meet in one shard. Runs of windows with one
anchor are a segment. Segments whose neighbourhood occurs once hold no repeat; equal segments are
all repeat; what is left, different segments that share a neighbourhood, is sorted: a shard's
segments form one suffix array by induced sorting, and the common prefixes of adjacent suffixes, in
text order, tell the repeated windows.

A neighbourhood that very many different segments share is not gathered in one shard: its segments
are cut into shorter runs of windows, which have more bytes in common by which to deal them, until
few share them or single windows are left.

Only numbers are exchanged to find the neighbourhoods; texts are read again for the segments that
must be sorted, and for the result. Two segments count as equal by their 64-bit XXH3 hashes, within a
neighbourhood that has equal bytes by such a hash, too.

Defined results: a null text is empty; repeated rows are separate documents, each the other's repeat;
texts shorter than a window keep all; very long texts are cut into segments like any other; there are
no ties to break; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.llm.arrays import PIECE, hash_spans, ragged, text_bytes
from snapline.llm.suffixes import permuted_prefixes, suffix_array
from snapline.operators.joins import spread_join
from snapline.session import scratch

WINDOW, GRAM = 400, 32
# Different segments that may share a neighbourhood in one shard.
CROWD = 500
# Bytes of segments that one suffix array holds.
SHARD_BYTES = 2 << 20
# Rows and list elements up to which a table without texts is broadcast; beyond, it is a shuffled join.
BROADCAST_ROWS = 1_000_000

_VALUE = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)
_SEGMENT = "d1 long, d2 long, place long, seg long, start int, n int"


def _cell(window: int) -> int:
    """How many places of the anchor share a neighbourhood at first: half of them."""
    return (window - GRAM + 2) // 2


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """``least[i]``: index of the (first) least of ``h[i : i + width]``."""
    best, reach = np.arange(len(h)), 1
    low = h
    while reach < width:
        step = min(reach, width - reach)
        a, b = low[:-step], low[step:]
        right = b < a
        low = np.where(right, b, a)
        best = np.where(right, best[step:], best[:-step])
        reach += step
    return best


def _segments(data: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Of one text: neighbourhood hash, content hash, first window and number of windows of each segment."""
    found = []
    step = PIECE - window
    for low in range(0, len(data) - window + 1, step):
        part = data[low : low + step + window - 1]
        last = len(part) - window  # the last window's start
        gram = hash_spans(part, np.arange(len(part) - GRAM + 1), np.arange(GRAM, len(part) + 1), _VALUE)
        anchor = _sliding_least(gram, window - GRAM + 1)[: last + 1]
        cell = (anchor - np.arange(last + 1)) // _cell(window)
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])]))
        n = np.diff(np.append(first, last + 1))
        place, seg = _hashes(part, anchor[first], cell[first], first, n, window, _cell(window))
        found.append((place, seg, first + low, n))
    return tuple(np.concatenate(x) for x in zip(*found))


def _hashes(data, anchor, cell, first, n, window, width) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of what all windows have in common that see the anchor in a cell of places, and of the segment."""
    low, raw, digest = anchor - cell * width, memoryview(data.tobytes()), xxhash.xxh3_64_intdigest
    shared = window - (width - 1)
    place = [digest(raw[a : a + shared], c) for a, c in zip(low.tolist(), cell.tolist())]
    seg = [digest(raw[a : a + k + window - 1]) for a, k in zip(first.tolist(), n.tolist())]
    return np.array(place, np.uint64).view(np.int64), np.array(seg, np.uint64).view(np.int64)


def _table(spark, df: DataFrame, name: str) -> DataFrame:
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _maybe_broadcast(df: DataFrame, weight) -> DataFrame:
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    return F.broadcast(df) if n + size <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``d1, d2``: 128 bits that stand for a row's id and text; equal rows share them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d1 = F.xxhash64(text, F.col(id_col))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select("*", d1.alias("d1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("d2"))


def _found(keyed: DataFrame, window: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            d1, d2 = (batch.column(i).to_numpy() for i in (0, 1))
            parts, owner, size = [], [], 0
            for i in np.flatnonzero(np.diff(bounds) >= window):
                parts.append(_segments(data[bounds[i] : bounds[i + 1]], window))
                owner.append(np.full(len(parts[-1][0]), i))
                size += len(owner[-1])
                if size > 100_000:
                    yield batch_of(d1, d2, parts, owner)
                    parts, owner, size = [], [], 0
            if parts:
                yield batch_of(d1, d2, parts, owner)

    def batch_of(d1, d2, parts, owner) -> pa.RecordBatch:
        row = np.concatenate(owner)
        place, seg, start, n = (np.concatenate(x) for x in zip(*parts))
        arrays = [d1[row], d2[row], place, seg, start.astype(np.int32), n.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["d1", "d2", "place", "seg", "start", "n"])

    return keyed.select("d1", "d2", "text").mapInArrow(rows, _SEGMENT)


def _sorted_out(contents: DataFrame, window: int) -> DataFrame:
    """``place, seg, first, n``: repeated windows of each content, from the suffix arrays of shards.

    ``contents`` has ``place, seg, content``, with at most a crowd of contents a place.
    """

    def shard(places, segs, texts) -> pa.RecordBatch:
        length = np.array([len(t) for t in texts])
        # Zero between contents: a suffix that runs over its content's end is like no window.
        data = np.frombuffer(b"".join(t + b"\0" for t in texts) + bytes(window + 8), np.uint8)
        signs = data[: -(window + 8)].astype(np.uint16) + 1
        end = np.cumsum(length + 1) - 1
        signs[end] = 0
        sa = suffix_array(signs, 257, window)
        same = permuted_prefixes(data, sa, window) >= window
        begin = end - length
        inside = np.zeros(len(signs) + 1, np.int64)
        count = length - window + 1
        np.add.at(inside, begin, 1)
        np.add.at(inside, begin + count, -1)
        valid = np.cumsum(inside[:-1]) > 0
        # Agreement with the suffix before in the array counts for both, if both are whole windows
        # (real zero bytes may look like the one between contents).
        later = sa[1:][same[sa[1:]] & valid[sa[1:]]]
        earlier = np.empty(len(sa), np.int64)
        earlier[sa[1:]] = sa[:-1]
        later = later[valid[earlier[later]]]
        hit = np.zeros(len(signs), bool)
        hit[later] = hit[earlier[later]] = True
        at = np.flatnonzero(hit)
        content = np.searchsorted(end, at, "left")
        new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(content) != 0)])) if len(at) else at
        own = content[new]
        arrays = [np.array(places)[own], np.array(segs)[own], (at[new] - begin[own]).astype(np.int32), np.diff(np.append(new, len(at))).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["place", "seg", "first", "n"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, segs, texts, size = [], [], [], 0
        for batch in batches:
            for place, seg, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if size >= SHARD_BYTES and place != places[-1]:  # a place's contents stay together
                    yield shard(places, segs, texts)
                    places, segs, texts, size = [], [], [], 0
                places.append(place)
                segs.append(seg)
                texts.append(content.as_py())
                size += len(texts[-1])
        if texts:
            yield shard(places, segs, texts)

    dealt = contents.select("place", "seg", "content").repartition("place").sortWithinPartitions("place")
    return dealt.mapInArrow(shards, "place long, seg long, first int, n int")


def _cut(crowded: DataFrame, window: int, width: int) -> DataFrame:
    """Segments in shorter runs, whose anchors lie in cells of ``width`` places."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {name: [] for name in ("place", "seg", "content", "up_place", "up_seg", "shift", "n")}
            for up_place, up_seg, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = content.as_py()
                data = np.frombuffer(raw, np.uint8)
                count = len(data) - window + 1
                gram = hash_spans(data, np.arange(len(data) - GRAM + 1), np.arange(GRAM, len(data) + 1), _VALUE)
                anchor = int(_sliding_least(gram, window - GRAM + 1)[0])
                cell = (anchor - np.arange(count)) // width
                first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                n = np.diff(np.append(first, count))
                place, seg = _hashes(data, np.full(len(first), anchor), cell[first], first, n, window, width)
                made["place"] += place.tolist()
                made["seg"] += seg.tolist()
                made["content"] += [raw[a : a + k + window - 1] for a, k in zip(first, n)]
                made["up_place"] += [up_place] * len(first)
                made["up_seg"] += [up_seg] * len(first)
                made["shift"] += first.tolist()
                made["n"] += n.tolist()
            yield pa.RecordBatch.from_pydict(made, schema=_CUT)

    return crowded.select("place", "seg", "content").mapInArrow(
        rows, "place long, seg long, content binary, up_place long, up_seg long, shift int, n int"
    )


_CUT = pa.schema([
    ("place", pa.int64()), ("seg", pa.int64()), ("content", pa.binary()), ("up_place", pa.int64()),
    ("up_seg", pa.int64()), ("shift", pa.int32()), ("n", pa.int32()),
])


def _kinds(distinct: DataFrame) -> DataFrame:
    """``p, kinds``: places that several different segments share."""
    return distinct.groupBy("place").agg(F.count("*").alias("kinds")).where("kinds > 1").withColumnRenamed("place", "p")


def _repeated(contents: DataFrame, window: int, width: int) -> DataFrame:
    """Repeated windows of different contents (``place, seg, content, kinds``); crowded places are cut up."""
    spark = contents.sparkSession
    found = _sorted_out(contents.where(F.col("kinds") <= CROWD), window)
    crowded = contents.where(F.col("kinds") > CROWD)
    if width == 1 or crowded.isEmpty():
        return found
    width = (width + 1) // 2
    cut = _table(spark, _cut(crowded, window, width), "cut")
    distinct = cut.groupBy("place", "seg").agg(F.count("*").alias("copies"), F.first("content").alias("content"), F.first("n").alias("n"))
    distinct = _table(spark, distinct, "contents")
    several = spread_join(distinct, _kinds(distinct), [("place", "p")], "inner")
    deeper = _repeated(several, window, width)
    whole = distinct.where("copies > 1").select("place", "seg", F.lit(0).alias("first"), "n")
    runs = deeper.join(distinct.where("copies = 1").select("place", "seg"), ["place", "seg"], "left_semi").union(whole)
    runs = runs.select(F.col("place").alias("p"), F.col("seg").alias("s"), "first", F.col("n").alias("run"))
    back = spread_join(cut.select("place", "seg", "up_place", "up_seg", "shift"), runs, [("place", "p"), ("seg", "s")], "inner")
    return found.union(back.select(F.col("up_place").alias("place"), F.col("up_seg").alias("seg"), F.col("shift") + F.col("first"), "run"))


def repeated_spans(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """``d1, d2, spans`` of the documents with repeated windows: their first and last starts."""
    spark = keyed.sparkSession
    segments = _table(spark, _found(keyed, window), "segments")
    # Neighbourhoods that occur once, most of them, end here.
    shared = segments.groupBy("place").agg(F.count("*").alias("k")).where("k > 1").select(F.col("place").alias("p"))
    segments = _table(spark, spread_join(segments, shared, [("place", "p")], "left_semi"), "shared")
    one = F.min(F.struct("d1", "d2", "start")).alias("one")
    distinct = _table(spark, segments.groupBy("place", "seg", "n").agg(F.count("*").alias("copies"), one), "contents")
    several = spread_join(distinct, _kinds(distinct), [("place", "p")], "inner")

    wanted = several.select("place", "seg", "n", "kinds", F.col("one.d1").alias("w1"), F.col("one.d2").alias("w2"), F.col("one.start").alias("start"))
    lists = wanted.groupBy("w1", "w2").agg(F.collect_list(F.struct("place", "seg", "n", "kinds", "start")).alias("wanted"))
    lists = _maybe_broadcast(_table(spark, lists, "wanted"), F.size("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            rows = [(data[bounds[i] + w["start"] : bounds[i] + w["start"] + w["n"] + window - 1].tobytes(), w)
                    for i, wanted in enumerate(batch.column(1).to_pylist()) for w in wanted]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([w[k] for _, w in rows], pa.int64()) for k in ("place", "seg", "kinds")), pa.array([c for c, _ in rows], pa.binary())],
                names=["place", "seg", "kinds", "content"],
            )

    # Equal rows are fetched once each; the distinct contents are what counts.
    same = (F.col("d1") == F.col("w1")) & (F.col("d2") == F.col("w2"))
    texts = keyed.select("d1", "d2", "text").join(lists, same).select("text", "wanted")
    contents = texts.mapInArrow(fetch, "place long, seg long, kinds long, content binary")
    contents = _table(spark, contents.dropDuplicates(["place", "seg"]), "texts")
    whole = distinct.where("copies > 1").select("place", "seg", F.lit(0).alias("first"), "n")
    alone = distinct.where("copies = 1").select("place", "seg")
    runs = _repeated(contents, window, _cell(window)).join(alone, ["place", "seg"], "left_semi").union(whole)
    runs = runs.select(F.col("place").alias("p"), F.col("seg").alias("s"), "first", F.col("n").alias("run"))
    at = spread_join(segments.select("d1", "d2", "place", "seg", "start"), runs, [("place", "p"), ("seg", "s")], "inner")
    first = F.col("start") + F.col("first")
    spans = at.select("d1", "d2", first.alias("a"), (first + F.col("run") - 1).alias("b")).distinct()  # equal rows: once
    return spans.groupBy("d1", "d2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes left) per document."""
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    spans = _table(spark, repeated_spans(keyed, window), "spans")
    schema = keyed.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("kept", "binary")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                raw, out, at, n = text.as_py().encode(), [], 0, 0
                for a, b in _merged_spans(spans or [], window):
                    out.append(raw[at:a])
                    at, n = b, n + 1
                made.append((len(raw), n, b"".join([*out, raw[at:]])))
            arrays = [
                batch.column(0), pa.array([s for s, _, _ in made], pa.int64()), pa.array([s - len(k) for s, _, k in made], pa.int64()),
                pa.array([n for _, n, _ in made], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for _, _, k in made]), pa.array([k for _, _, k in made], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return keyed.join(spans, ["d1", "d2"], "left").select("doc_id", "text", "spans").mapInArrow(removed, schema)


def _merged_spans(spans: list[dict], window: int) -> list[tuple[int, int]]:
    """Covered bytes as maximal runs."""
    made: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"] + window) for s in spans):
        if made and a <= made[-1][1]:
            made[-1][1] = max(made[-1][1], b)
        else:
            made.append([a, b])
    return [(a, b) for a, b in made]
