import random

import pytest
import xxhash
from pyspark.sql import functions as F

from snapline.llm import simhash as S
from snapline.llm.components import components
from tests.llm.conftest import LONG


def plain(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, bits=2):
    up = list(range(len(fps)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                up[top(i)] = top(j)
    return [top(i) for i in range(len(fps))]


def test_fingerprint():
    for text in ("", None, " \t", "one", "one two", "One two\x0bthree", "a b c d e f", "é x y z", "a b\n a b a b a b"):
        assert S.fingerprint(text) == plain(text)
    assert S.fingerprint(LONG) == plain(LONG)


def test_spark_hashes_alike(llm):
    row = llm.createDataFrame([("one two three",)], "s string").select(F.xxhash64("s")).first()[0]
    assert row % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


@pytest.mark.parametrize("dense", [2, 8, 10_000])
def test_links_connect_what_brute_force_connects(llm, monkeypatch, dense):
    monkeypatch.setattr(S, "DENSE", dense)
    drawn = random.Random(4)
    fps = []
    for size in (60, 25, 8, 3, 2):  # chains and clusters around a few values
        base = drawn.getrandbits(64)
        for _ in range(size):
            fps.append(base)
            for _ in range(drawn.randrange(1, 4)):
                base ^= 1 << drawn.randrange(64)
    fps = list(dict.fromkeys([*fps, *(drawn.getrandbits(64) for _ in range(100)), 0, 1, (1 << 64) - 1]))
    df = llm.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    got = {r.fp: r.root for r in S.roots(df).collect()}
    want = groups(fps)
    pairs = {(got[S._signed(f)], w) for f, w in zip(fps, want)}
    assert len(got) == len(fps) and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_discarded_pairs_are_never_links():
    drawn = random.Random(2)
    pivots = [drawn.getrandbits(64) for _ in range(S.REFERENCES)]
    for _ in range(300):
        a = drawn.getrandbits(64)
        b = a ^ 1 << drawn.randrange(64) ^ 1 << drawn.randrange(64)
        assert max(abs((a ^ p).bit_count() - (b ^ p).bit_count()) for p in pivots) <= 2


def test_long_chain_is_one_component(llm):
    links = llm.range(60).selectExpr("id AS u", "id + 1 AS v")
    assert {(r.u, r.v) for r in components(links).collect()} == {(i, 0) for i in range(1, 61)}
    assert components(links.where("u < 0")).count() == 0


def expected(rows):
    fps = [plain(r.text) for r in rows]
    top = groups(fps)
    least = {}
    for r, t in zip(rows, top):
        if r.doc_id is not None:
            least[t] = min(least.get(t, r.doc_id), r.doc_id)
    return fps, top, least


def test_table(messy, nothing):
    rows = messy.collect()
    fps, top, least = expected(rows)
    want = [(r.doc_id, f"{f:016x}", least.get(t)) for r, f, t in zip(rows, fps, top)]
    assert sorted(map(repr, map(tuple, S.near_duplicates(messy).collect()))) == sorted(map(repr, want))
    assert S.near_duplicates(nothing).count() == 0


def test_one_of_each_group_stays(messy, nothing):
    rows = messy.collect()
    _, top, least = expected(rows)
    kept = S.keep_one(messy)
    assert kept.columns == messy.columns and kept.count() == len(set(top))
    assert {r.doc_id for r in kept.collect()} == {least.get(t) for t in top}
    assert S.keep_one(nothing).count() == 0
