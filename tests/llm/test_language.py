import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snapline.llm import language as L
from snapline.llm.arrays import text_bytes

SYLLABLES = {"aa": ["ba", "do", "mé", "tu"], "bb": ["kri", "sto", "wün", "gel"], "cc": ["ñu", "que", "los", "cia"]}


def said(lang, n, seed):
    drawn = random.Random(seed)
    return " ".join("".join(drawn.choices(SYLLABLES[lang], k=drawn.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(llm):
    rows = [(i, said(lang, 3 + i % 30, i), lang) for i in range(240) for lang in [("aa", "bb", "cc")[i % 3]]]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(docs):
    got = L.languages(docs).join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    apart = [r for r in got if r.held_out]
    assert len(apart) > 40 and np.mean([r.lang_pred == r.lang for r in apart]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_learned_from(docs):
    changed = docs.withColumn("lang", F.when(L.held_out("doc_id"), "zz").otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, L.languages(d).collect())) for d in (docs, changed))
    assert a == b


def test_against_brute_force(docs):
    blocks = L.train(docs, ~L.held_out("doc_id"))
    [(langs, matrix)] = blocks
    assert langs == ["aa", "bb", "cc"]
    text = said("bb", 12, 5) + " x9é"
    data, bounds = text_bytes(pa.array([text]))
    log = matrix[-1].astype(float)
    n = 0
    for _, bucket in L.grams(data, bounds, L.BUCKETS):
        log = log + matrix[bucket].sum(axis=0)
        n += len(bucket)
    assert n == sum(len(text) - k + 1 for k in L.GRAMS)
    row = L.identify(docs.limit(1).withColumn("text", F.lit(text)), blocks, ["doc_id"]).first()
    assert row.lang_pred == langs[int(log.argmax())]
    assert abs(row.score - 1 / np.exp(log - log.max()).sum()) < 1e-4


def test_grams_of_a_long_text_are_whole(monkeypatch):
    text = "aé中😀 b" * 50
    data, bounds = text_bytes(pa.array(["xy", text, None, "z"]))
    whole = sorted((int(r), int(b)) for rs, bs in L.grams(data, bounds, L.BUCKETS) for r, b in zip(rs, bs))
    monkeypatch.setattr(L, "PIECE", 32)
    assert sorted((int(r), int(b)) for rs, bs in L.grams(data, bounds, L.BUCKETS) for r, b in zip(rs, bs)) == whole


def test_table(messy, nothing, docs):
    got = L.languages(messy.unionByName(docs, allowMissingColumns=True)).where("doc_id < 9 OR doc_id IS NULL").collect()
    blank = [r for r in L.languages(messy).collect() if r.lang_pred == "und"]
    assert len(got) > messy.count() - 1 and len(blank) == 5 and all(r.score == 0 for r in blank)
    assert L.languages(nothing).count() == 0
    assert {r.lang_pred for r in L.languages(messy.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_blocks_of_languages_give_the_same(docs, messy):
    """However many languages there are, a language's buckets and its predictions stay as they are."""
    whole = docs.unionByName(messy, allowMissingColumns=True)
    learn = ~L.held_out("doc_id") & F.col("doc_id").isNotNull()
    said_ = lambda block: L.identify(whole, L.train(whole, learn, block=block), ["doc_id"])
    want = sorted((repr(r.doc_id), r.lang_pred, round(r.score, 6)) for r in said_(64).collect())
    for block in (1, 2):
        blocks = L.train(whole, learn, block=block)
        assert max(len(langs) for langs, _ in blocks) == block and all(m.shape[0] == L.BUCKETS + 1 for _, m in blocks)
        assert sorted((repr(r.doc_id), r.lang_pred, round(r.score, 6)) for r in said_(block).collect()) == want
