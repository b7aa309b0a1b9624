import hashlib
import re
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snapline.llm import pii as P

# The stated patterns.
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    spans = []
    for kind, pattern in enumerate(PATTERNS):
        if kind == 0 and "@" not in text:  # the pattern is quadratic in long words
            continue
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d)) for i, d in enumerate(reversed(digits)))
            fits = (
                True, all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                12 <= len(digits) <= 19 and doubled % 10 == 0, 9 <= len(digits) <= 15,
            )[kind]
            if fits:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


BITS = st.lists(st.sampled_from(["a", "Z", "@", ".", "-", "+", " ", "1", "42", "555", "4111 1111 1111 1111", "10.0.0.1", "256.1.1.1", "x@y.z", "(", ")", "_", "%", "é", "\n", "+1 (555) 010-9999"]), max_size=16)


@settings(max_examples=600, deadline=None)
@given(BITS)
def test_rules_equal_the_patterns(bits):
    assert P.base_spans("".join(bits)) == plain("".join(bits))


def test_parts_of_very_many_zeros_are_small_numbers():
    text = "0" * 5000 + "7.1.2.255"
    assert P.base_spans(text) == [(0, 1, len(text))]
    assert P.base_spans("1.1.1." + "9" * 5000) == P.base_spans("256.0.0.1") == []


def test_many_spans_in_one_text():
    line = "a@b.cd 10.0.0.1 "
    spans = P.base_spans(line * 20_000)
    assert len(spans) == 40_000
    every = [t for run in P.runs(line * 20_000) for t in run]
    assert P.run_labels(every, spans)[:3] == [1, 3, 1] and len(every) == 40_000
    assert P.added_spans(line * 20_000, [every], [np.array(P.run_labels(every, spans))], spans) == []


def test_first_overlap_against_brute_force():
    drawn = np.random.default_rng(5)
    for _ in range(50):
        spans = sorted((int(a), 0, int(a + n)) for a, n in zip(drawn.integers(0, 60, 12), drawn.integers(1, 20, 12)))
        first, at = P._first_over(spans), 0
        while at < 80:
            end = at + int(drawn.integers(1, 6))
            assert first(at, end) == next((x for x in spans if x[0] < end and at < x[2]), None)
            at = end


def test_rules_are_linear_in_long_texts():
    for text in ("a" * 2_000_000 + "@", "1" * 300_000, "+1" * 300_000, "1 " * 500_000, "a@" * 500_000, "9." * 500_000):
        P.base_spans(text)
        P.runs(text[:300_000])


def best_by_hand(field, features):
    n, move = len(P.LABELS), np.where(P.ALLOWED, field.transition, -1e4)
    emit = field.emission[features].sum(axis=1)
    score = lambda y: move[0, y[0]] + sum(emit[t, y[t]] for t in range(len(y))) + sum(move[a, b] for a, b in zip(y, y[1:])) + move[y[-1], 0]
    return max(product(range(n), repeat=len(features)), key=score)


def test_decoding_against_brute_force():
    drawn = np.random.default_rng(3)
    field = P.Field(drawn.normal(size=(P.FEATURES, len(P.LABELS))), drawn.normal(size=(len(P.LABELS), len(P.LABELS))))
    features = [drawn.integers(0, P.FEATURES, (k, P.N_FEATURES)) for k in (1, 2, 3, 3)]
    for f, got in zip(features, P.decode(field, features)):
        assert tuple(got) == best_by_hand(field, f)


@pytest.fixture(scope="module")
def field():
    texts = [f"call +1 (555) 010-{i:04d} or mail user{i}@example.org now {i % 7} times from 10.0.{i % 250}.7 in 19{i % 90 + 10}" for i in range(120)]
    features = [P.run_features(t, r) for t in texts for r in P.runs(t)]
    labels = [P.run_labels(r, P.base_spans(t)) for t in texts for r in P.runs(t)]
    return P.train_field(features, labels)


def test_training_learns_held_out_runs(field):
    texts = [f"ring +1 (555) 777-{i:04d}, write to someone{i}@mail.example.com, {i} from 172.16.{i}.1" for i in range(30)]
    right = total = 0
    for text in texts:
        for run in P.runs(text):
            got = P.decode(field, [P.run_features(text, run)])[0].tolist()
            right += sum(a == b for a, b in zip(got, P.run_labels(run, P.base_spans(text))))
            total += len(run)
    assert right / total > 0.9


def test_added_spans_leave_the_rules_alone(field):
    text = "10.0.0.7 and 10.0.300.7 and 2001 words"
    [(base, spans)] = P.find_spans([text], field)
    assert base == plain(text) and set(base) <= set(spans)
    assert all(e <= s for (_, _, e), (s, _, _) in zip(spans, spans[1:]))


def test_table(messy, nothing, llm):
    more = llm.createDataFrame([(20, "a@b.co, 10.0.0.1; 4111-1111-1111-1111 +44 20 7946 0958")], "doc_id long, text string")
    docs = messy.unionByName(more, allowMissingColumns=True)
    rows, got = docs.collect(), P.personal_data(docs).collect()
    assert len(got) == len(rows)
    want = sorted((repr(r.doc_id), hashlib.sha256(P.written(plain(r.text or "")).encode()).hexdigest()) for r in rows)
    assert sorted((repr(r.doc_id), r.base_sha256) for r in got) == want
    row = next(r for r in got if r.doc_id == 20)
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1) and "email:0:6" in row.spans
    assert P.personal_data(nothing).count() == 0


def test_redaction(llm, messy, nothing):
    docs = llm.createDataFrame([(1, "write a@b.co or 10.0.0.1!", 25), (2, None, None), (3, "nothing", 7)], "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, P.redact(docs).collect())) == [(1, "write <EMAIL> or <IP>!", 22), (2, None, None), (3, "nothing", 7)]
    assert P.redacted("12345", [(0, 2, 3), (2, 3, 4)]) == "<CARD>5"
    made = P.redact(messy)
    assert made.columns == messy.columns and made.count() == messy.count()
    assert P.redact(nothing).count() == 0


def test_memory_is_given_back_between_parts(monkeypatch):
    """Workers are used again by other operators' tasks, whose unused memory counted against this one."""
    seen = []
    monkeypatch.setattr(P, "release", lambda: seen.append(1))
    monkeypatch.setattr(P, "TOGETHER", 20)
    field = P.train_field([], [])
    texts = ["mail a@b.org or call", "nothing here at all, nothing", "ip 10.0.0.1"]
    assert P.find_spans(texts, field) == [P.find_spans([t], field)[0] for t in texts] and seen
