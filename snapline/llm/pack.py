"""Packing token sequences: cost-balanced, with no padding.

A document's tokens cost ``linear * n + quadratic * n^2`` (attention looks at pairs within a
document). Documents are tokenised and packed a bucket of some million tokens at a time, inside the
task that reads them: nothing is shuffled, memory is bounded, and a lost task packs the same bucket
again. A bucket opens as many full sequences as its tokens fill and, for the rest, sequences whose
lengths are powers of two, which need no padding either; so every sequence ends up full. Documents
go, longest first, to the cheapest sequence with capacity left; what does not fit there is cut off
and goes on as a document of its own.

Defined results: a null text is empty and consists of its end id; repeated rows are separate
documents; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

SEQUENCE = 2048
BUCKET_TOKENS = 4 << 20
# The cost of a token, and of a pair of tokens that attend to each other.
LINEAR, QUADRATIC = 1.0, 1.0 / 512
TOKENIZER = "byte_bpe_50k.json"
END_ID = 1

# Words whose ids a worker remembers, and the longest of them (characters).
REMEMBERED, LONGEST = 1_000_000, 48

# A single space or line break between two plain characters always begins a new token, so what lies
# between them can be tokenised by itself, once for all its occurrences. So can letters, and signs
# (other than an apostrophe) after them.
_PLAIN = r"[!-~¡-ɏ]"
_IS_PLAIN = re.compile(_PLAIN).match
_SPLIT = re.compile(rf"(?<={_PLAIN}) (?={_PLAIN})")
_BREAK = re.compile(rf"(?<={_PLAIN})\n(?={_PLAIN})")
_LETTERS_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]+)")
_ALL_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch
# How a byte-level model writes bytes: visible Latin-1 characters as they are, the others from U+0100 on.
_HIDDEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or 174 <= b)]
_SIGNS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


class _OddSpace(Exception):
    """A space that is not between two plain characters."""


def _splits_letters(tokenizer: Tokenizer) -> bool:
    """Whether texts are cut at letters and written byte by byte before the model sees them."""
    probe = " aé b"
    return isinstance(tokenizer.pre_tokenizer, ByteLevel) and [
        signs for signs, _ in tokenizer.pre_tokenizer.pre_tokenize_str(probe)
    ] == [part.encode().decode("latin-1").translate(_SIGNS) for part in (" aé", " b")]


class _Ids(dict):
    """Word to the little-endian 32-bit ids of its tokens: at a text's begin, or after a space."""

    def __init__(self, tokenizer: Tokenizer, first: _Ids | None = None):
        super().__init__()
        self.tokenizer, self.space, self.first = tokenizer, " " * (first is not None), self if first is None else first
        self.model, self.byte_level = tokenizer.model, tokenizer.normalizer is None and _splits_letters(tokenizer)

    def __missing__(self, word: str) -> bytes:
        if self.space and not (_IS_PLAIN(word) and _IS_PLAIN(word[-1])):
            raise _OddSpace
        if "\n" in word and len(lines := _BREAK.split(word)) > 1:
            made = self[lines[0]] + b"".join(self.first["\n"] + self.first[line] for line in lines[1:])
        elif parts := _LETTERS_SIGNS.fullmatch(word):
            made = self[parts[1]] + self.first[parts[2]]
        else:
            made = self.encoded(word)
        if len(self) < REMEMBERED and len(word) <= LONGEST:
            self[word] = made
        return made

    def encoded(self, word: str) -> bytes:
        if self.byte_level and _ALL_LETTERS(word):  # one run for the model, which is a third of the work
            signs = (self.space + word).encode().decode("latin-1").translate(_SIGNS)
            ids = [token.id for token in self.model.tokenize(signs)]
        else:
            ids = self.tokenizer.encode(self.space + word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


_memory: dict[str, tuple[_Ids, _Ids, tuple[str, ...]]] = {}


def token_bytes(text: str, file: str = TOKENIZER) -> bytes:
    """The ids of a text, four bytes each."""
    if file not in _memory:  # once per worker process
        tokenizer = Tokenizer.from_file(public_tokenizers.path(file) if "/" not in file else file)
        first = _Ids(tokenizer)
        marks = tuple(token.content for token in tokenizer.get_added_tokens_decoder().values())
        _memory[file] = (first, _Ids(tokenizer, first), marks)
    first, rest, marks = _memory[file]
    if any(mark in text for mark in marks):  # such a mark is one token wherever it stands
        return first.encoded(text)
    words = text.split(" ")
    try:
        if words[0] and not _IS_PLAIN(words[0][-1]) and len(words) > 1:
            raise _OddSpace
        ids = [first[words[0]], *map(rest.__getitem__, words[1:])] if words[0] else [first[text]]
    except _OddSpace:
        words = _SPLIT.split(text)
        ids = [first[words[0]], *map(rest.encoded, words[-1:] if len(words) > 1 else [])]
        ids[1:1] = map(rest.__getitem__, words[1:-1])
    return b"".join(ids)


def capacities(tokens: int, sequence: int = SEQUENCE) -> list[int]:
    """Full sequences, and powers of two for the rest."""
    rest = tokens % sequence
    return [sequence] * (tokens // sequence) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def assign(
    lengths: list[int], sequence: int = SEQUENCE, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> Iterator[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of each piece."""
    room = capacities(sum(lengths), sequence)
    used = [0] * len(room)
    # Heaps: pieces from the longest, sequences from the cheapest (the larger first among equals).
    pieces = [(-n, d, 0) for d, n in enumerate(lengths)]
    cheapest = [(0.0, -c, s) for s, c in enumerate(room)]
    heapq.heapify(pieces)
    heapq.heapify(cheapest)
    while pieces:
        n, doc, start = heapq.heappop(pieces)
        cost, _, s = heapq.heappop(cheapest)
        placed = min(-n, room[s] - used[s])
        yield doc, start, placed, s, used[s]
        used[s] += placed
        if used[s] < room[s]:
            heapq.heappush(cheapest, (cost + linear * placed + quadratic * placed * placed, used[s] - room[s], s))
        if placed < -n:
            heapq.heappush(pieces, (n + placed, doc, start + placed))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
    bucket: int = BUCKET_TOKENS,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece."""
    id_type = docs.schema[id_col].dataType
    end = np.array([END_ID], dtype="<u4").tobytes()

    def packed(ids: list, texts: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = [len(t) // 4 for t in texts]
        made = [
            (ids[d], start, n, zlib.crc32(memoryview(texts[d])[4 * start : 4 * (start + n)]), lengths[d], first + s, offset)
            for d, start, n, s, offset in assign(lengths)
        ]
        columns = [list(c) for c in zip(*made)]
        arrays = [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])]
        return pa.RecordBatch.from_arrays(arrays, names=_NAMES), first + len(capacities(sum(lengths)))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Unique over the job: the partition in the upper bits.
        first = TaskContext.get().partitionId() << 36
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                tokens = token_bytes(text.as_py() or "", tokenizer) + end
                ids.append(doc.as_py())
                texts.append(tokens)
                size += len(tokens) // 4
                if size >= bucket:
                    made, first = packed(ids, texts, first)
                    yield made
                    ids, texts, size = [], [], 0
        if texts:
            yield packed(ids, texts, first)[0]

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    schema = "doc_id string, " + ", ".join(f"{n} long" for n in _NAMES[1:])
    return rows.mapInArrow(buckets, schema).withColumn("doc_id", F.col("doc_id").cast(id_type))


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
