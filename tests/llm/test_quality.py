import numpy as np
import pytest

from snapline.llm import quality as Q
from tests.llm.conftest import words


@pytest.fixture(scope="module")
def docs(llm):
    text = lambda i: words(40, i, "abcdef") if i % 3 else words(40, i, "uvw#%!")
    return llm.createDataFrame([(i, text(i)) for i in range(300)], "doc_id long, text string")


@pytest.fixture(scope="module")
def labels(llm):
    return llm.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")


def test_good_text_weighs_more_and_is_drawn_more(docs, labels):
    got = Q.resample(docs, labels).collect()
    assert len(got) == 300 and sum(r.selected for r in got) == 150
    good, junk = ([r for r in got if bool(r.doc_id % 3) == kind] for kind in (True, False))
    assert min(r.log_weight for r in good if r.held_out) > max(r.log_weight for r in junk if r.held_out)
    assert np.mean([r.selected for r in good]) > 0.7 and np.mean([r.selected for r in junk]) < 0.1


def test_weights_against_brute_force(docs, labels):
    ratio = Q.train(docs, Q.F.col("doc_id") % 3 > 0)
    rows = {r.doc_id: r.text.encode() for r in docs.collect()}
    seen, good = {}, {}
    for i, raw in rows.items():
        for n in Q.GRAMS:
            for k in range(len(raw) - n + 1):
                seen[raw[k : k + n]] = seen.get(raw[k : k + n], 0) + 1
                good[raw[k : k + n]] = good.get(raw[k : k + n], 0) + (i % 3 > 0)
    p = lambda c, g: (c[g] + Q.SMOOTHING) / (sum(c.values()) + Q.SMOOTHING * Q.BUCKETS)
    raw = rows[7]
    own = [raw[k : k + n] for n in Q.GRAMS for k in range(len(raw) - n + 1)]
    want = Q.LENGTH * np.mean([np.log(p(good, g) / p(seen, g)) for g in own])
    got = Q.weigh(docs.where("doc_id = 7"), ratio, ["doc_id"]).first().log_weight
    assert abs(got - want) < 0.05 * Q.LENGTH  # few grams share a bucket


@pytest.mark.parametrize("left", [1000, 3])
def test_kth_greatest(llm, monkeypatch, left):
    monkeypatch.setattr(Q, "LEFT", left)
    monkeypatch.setattr(Q, "BINS", 8)
    values = [float(x) for x in np.random.default_rng(1).normal(size=400)] + [0.5] * 60
    df = llm.createDataFrame([(v,) for v in values], "v double")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 57, 120, 200, 459, 460):
        assert Q.kth_greatest(df, "v", k) == ranked[k - 1]
    assert Q.kth_greatest(df, "v", 0) is None and Q.kth_greatest(df.where("false"), "v", 1) is None


def test_table(llm, messy, nothing, labels):
    got = Q.resample(messy, labels).collect()
    assert len(got) == messy.count() and sum(r.selected for r in got) >= messy.count() / 2
    assert all(r.log_weight == 0 for r in got if r.doc_id in (3, 4))
    assert Q.resample(nothing, labels).count() == 0
    assert {r.log_weight for r in Q.resample(messy, labels.where("false")).collect()} == {0.0}
    assert sorted(map(repr, Q.resample(messy, labels).collect())) == sorted(map(repr, got))
