import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from snapline.llm import decontaminate as D
from snapline.llm.arrays import text_bytes, words_of
from tests.llm.conftest import LONG, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(texts, items, size=10):
    windows = {}
    for item, text in items:
        w = lower(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    made = []
    for text in texts:
        w, hit, found = lower(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        made.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return made


def test_words_of_whole_texts():
    texts = ["Hello, wörld x9", None, "", "ab", "cd", LONG, "--a--", "a\x00b", "ÀB ÀB"]
    data, bounds = text_bytes(pa.array(texts))
    found = words_of(data, bounds)
    assert found.per_row.tolist() == [len(lower(t)) for t in texts]
    same = {}
    for text, low, high in zip(texts, found.first, found.first[1:]):
        for word, h in zip(lower(text), found.hashes[low:high]):
            assert same.setdefault(word, h) == h
    assert len(set(same.values())) == len(same)


ITEMS = [(1, words(40, 3)), (2, words(25, 5)), (3, "tail"), (4, "é中😀 " + words(30, 9)), (5, None), (6, "..."), (None, words(12, 8)), (1, words(40, 3)), (7, "zz yy")]


@pytest.mark.parametrize("block", [100_000, 7])
def test_against_brute_force(llm, messy, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_WINDOWS", block)
    items = llm.createDataFrame(ITEMS, "item_id int, text string")
    got = D.decontaminate(messy, items).collect()
    rows = messy.collect()
    want = [(r.doc_id, *e) for r, e in zip(rows, expected([r.text for r in rows], ITEMS))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_vocabulary_beyond_its_bound_changes_nothing(llm, messy, monkeypatch):
    items = llm.createDataFrame(ITEMS, "item_id int, text string")
    want = sorted(map(repr, D.decontaminate(messy, items).collect()))
    monkeypatch.setattr(D, "VOCABULARY", 3)
    assert sorted(map(repr, D.decontaminate(messy, items).collect())) == want


def test_stage_drops_only_hits(llm, messy):
    items = llm.createDataFrame(ITEMS, "item_id int, text string")
    kept = D.remove_contaminated(messy, items)
    assert kept.columns == messy.columns
    rows = messy.collect()
    clean = [r for r, e in zip(rows, expected([r.text for r in rows], ITEMS)) if not e[-1]]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, clean))


def test_empty_tables(llm, messy, nothing):
    items = llm.createDataFrame([], "item_id int, text string")
    assert not any(r.contaminated for r in D.decontaminate(messy, items).collect())
    assert D.decontaminate(nothing, items).count() == 0


def test_proximity(llm, tmp_path):
    docs = llm.createDataFrame([(1, "alpha x beta y gamma"), (2, "alpha x x x x x x beta gamma"), (3, "alpha beta")], "doc_id long, text string")
    items = llm.createDataFrame([(1, "gamma beta alpha")], "item_id int, text string")
    index = D.build_index(docs, str(tmp_path / "index"), "doc_id")
    near = D.matches(index, D.item_windows(items, 3), within=4)
    ids = {(r.segment, i): d for r in index.collect() for i, d in enumerate(r.ids)}
    assert [ids[r.segment, r.doc] for r in near.collect()] == ["1"]
    assert D.matches(index, D.item_windows(items, 3)).count() == 0


def test_hash_is_of_the_word_alone():
    data, bounds = text_bytes(pa.array(["abc", "xx abc", "ABC."]))
    h = words_of(data, bounds).hashes
    assert h[0] == h[2] == h[3] and len(np.unique(h)) == 2
