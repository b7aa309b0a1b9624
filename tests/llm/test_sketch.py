import hashlib

import pytest
from pyspark.sql import functions as F

from snapline.llm import sketch as S
from tests.llm.conftest import words


def edited(rows):
    """By id: the edited texts, from the definition."""
    by_id = {}
    for i, text in rows:
        by_id.setdefault(i, []).append(text or "")
    ids = sorted(by_id, key=lambda i: (i is None, 0 if i is None else -i))
    for k, i in enumerate(ids):
        after = min(by_id[ids[(k + 1) % len(ids)]], key=lambda t: hashlib.md5(t.encode()).hexdigest())
        for text in by_id[i]:
            n = len(text) // 3
            yield i, len(text), hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest()


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_edited_texts(messy, monkeypatch, bound):
    monkeypatch.setattr(S, "BROADCAST_IDS", bound)
    got = S.edited_fingerprints(messy).collect()
    want = list(edited([(r.doc_id, r.text) for r in messy.collect()]))
    assert sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in got) == sorted(map(repr, want))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_likeness(llm):
    texts = [words(400, i) for i in range(30)]
    texts[7] = texts[6]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in S.edited_fingerprints(docs).collect()}
    assert got[7].fingerprint == got[6].fingerprint and got[7].near_next == 1.0
    assert len({r.fingerprint for r in got.values()}) == 29
    others = [r for r in got.values() if r.doc_id != 7]
    assert max(r.near_next for r in others) < 0.1
    assert 0.5 < sum(r.near_edited for r in others) / len(others) < 0.85


def test_sketches_merge_and_estimate_containment(llm):
    a, b = words(3000, 1), words(200, 2)
    df = llm.createDataFrame([(a, b, a + " " + b)], "a string, b string, both string")
    for name in ("a", "b", "both"):
        df = S.sketch(df, name, f"{name}_s")
    row = df.select(
        F.size(F.array_except("a_s", "both_s")).alias("lost_a"), F.size(F.array_except("b_s", "both_s")).alias("lost_b"),
        F.size("both_s").alias("n"), S.likeness("b_s", "both_s").alias("inside"),
    ).first()
    assert row.lost_a == row.lost_b == 0 and row.inside == 1.0
    assert abs(row.n - 3200 / 8) < 80


def test_plan_stays_in_the_jvm(messy):
    plan = S.edited_fingerprints(messy)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_empty_and_single(llm, nothing):
    assert S.edited_fingerprints(nothing).count() == 0
    one = S.edited_fingerprints(llm.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0


def test_next_ids_over_many_ranges(llm):
    ids = llm.range(0, 5000, 7).select((F.col("id") * F.col("id") % 100_003).alias("id")).union(llm.sql("SELECT CAST(NULL AS BIGINT)"))
    known = sorted({r.id for r in ids.collect() if r.id is not None}, reverse=True) + [None]
    got = {r.id: r.next for r in S.next_ids(ids).collect()}
    assert got == dict(zip(known, known[1:] + known[:1]))
