"""Fill-in-middle transformation of whole texts.

A text is cut into units: a run of signs with the white space before it, or white space at the end.
Prefix, middle and suffix are whole numbers of units, drawn by a hash of the id, and are put in the
order that a model is trained on. To find where so many units end, a text is seen as blocks of fixed
size; a Fenwick tree over them holds how many units end in a block and how many code points begin in
it. Descending the tree by halving steps finds the block of a cut, with units and code points before
it; only that block is looked at for the place.

Defined results: a null text is empty; an empty text, and one that holds a mark, stays plain; a null
id hashes like an empty text; repeated rows, which have the same hashes, are cut alike, and there are
no ties; texts of any length are whole; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.llm.arrays import text_bytes

# Fixed values.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, PLAIN, SUFFIX_FIRST = 42, 50, 80
BLOCK = 4096

_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


class Cuts:
    """Where units end in a text (UTF-8)."""

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        blocks = -(-len(data) // block)
        self.size = 1 << max(blocks - 1, 0).bit_length()
        solid = ~_SPACE[data]
        self.ends = solid.copy()
        if len(data):
            self.ends[:-1] &= ~solid[1:]
            self.ends[-1] = True  # of the last run, or of white space at the end
        # A code point begins where no continuation byte is.
        begins = (data & 0xC0) != 0x80
        at = np.arange(0, len(data), block)
        self.tree = np.zeros((2, self.size + 1), np.int64)
        if len(data):
            self.tree[:, 1 : blocks + 1] = np.add.reduceat(self.ends, at, dtype=np.int64), np.add.reduceat(begins, at, dtype=np.int64)
        self.units = int(self.tree[0].sum())
        step = 1
        while step < self.size:  # each node takes in the one that ends half way
            self.tree[:, 2 * step :: 2 * step] += self.tree[:, step : -step : 2 * step]
            step *= 2

    def after(self, units: int) -> tuple[int, int]:
        """Bytes and code points up to the end of so many units."""
        if units == 0:
            return 0, 0
        place, left, points, step = 0, units, 0, self.size
        while step:
            # The block sought is behind all nodes that end fewer units than are wanted.
            if place + step <= self.size and self.tree[0, place + step] < left:
                place += step
                left -= int(self.tree[0, place])
                points += int(self.tree[1, place])
            step >>= 1
        low = place * self.block
        end = int(np.flatnonzero(self.ends[low : low + self.block])[left - 1]) + 1
        return low + end, points + int(np.count_nonzero((self.data[low : low + end] & 0xC0) != 0x80))


def draws(doc_id, seed: int = SEED) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id, data: np.ndarray, seed: int = SEED, block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle, and the output of one text."""
    raw, (h1, h2, h3, h4) = data.tobytes(), draws(doc_id, seed)
    cuts = Cuts(data, block)
    if not raw or h3 % 100 >= PLAIN or any(m in raw for m in _MARKS):
        return cuts.units, "plain", None, None, raw
    (a, prefix), (b, middle) = (cuts.after(k) for k in sorted((h1 % (cuts.units + 1), h2 % (cuts.units + 1))))
    p, s, m = _MARKS
    if h4 % 100 < SUFFIX_FIRST:
        return cuts.units, "spm", prefix, middle - prefix, b"".join([s, raw[b:], p, raw[:a], m, raw[a:b]])
    return cuts.units, "psm", prefix, middle - prefix, b"".join([p, raw[:a], s, raw[b:], m, raw[a:b]])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))
    schema = rows.select("doc_id").schema
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")):
        schema = schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            made = [transformed(i, data[a:b], seed, block) for i, a, b in zip(batch.column(1).to_pylist(), bounds[:-1], bounds[1:])]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array([row[at] for row in made], kind) for at, kind in enumerate(kinds)]
            output = pa.array([row[4] for row in made], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, output], names=schema.fieldNames())

    return rows.mapInArrow(cut, schema)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text, rebuilt from an output and its form alone: no part holds a mark, so three parts are left."""
    inner, whole = F.expr(f"substring({output}, 4)"), F.col(output)
    prefix_first, suffix_first = F.split(inner, f"{SUFFIX}|{MIDDLE}", -1), F.split(inner, f"{PREFIX}|{MIDDLE}", -1)
    return (
        F.when(F.col(form) == "psm", F.concat(prefix_first[0], prefix_first[2], prefix_first[1]))
        .when(F.col(form) == "spm", F.concat(suffix_first[1], suffix_first[2], suffix_first[0]))
        .otherwise(whole)
    )
