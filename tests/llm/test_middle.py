import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapline.llm import middle as M
from tests.llm.conftest import LONG

UNITS = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    h = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    own = UNITS.findall(text)
    a, b = sorted((h1 % (len(own) + 1), h2 % (len(own) + 1)))
    p, m, s = "".join(own[:a]), "".join(own[a:b]), "".join(own[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(own), "plain", None, None, text
    if h4 % 100 < 80:
        return len(own), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(own), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", None, " ", "a", " a", "a ", "\t\n a  b\x0b\x0c\r", "é中😀 x\u00a0y \u2003z", "a <P> b", "x<S>", "<M>", "a<b <P b P> c", "\x00 \x1c a\x85b ", "<S <M <P " * 5]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_table(llm, messy, block):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(300)] + [(None, "a b c d"), (5, LONG)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").unionByName(messy.select("doc_id", "text"))
    if block < 4096:
        docs = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 10_000)
    got = M.fill_in_middle(docs, block=block).withColumn("again", M.restored()).collect()
    want = [(r.doc_id, *plain(r.doc_id, r.text)) for r in docs.collect()]
    assert sorted(repr(tuple(r)[:6]) for r in got) == sorted(map(repr, want))
    assert sorted(r.again for r in got) == sorted(r.text or "" for r in docs.collect())
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_and_clashing(llm, messy, nothing):
    assert M.fill_in_middle(nothing).count() == 0
    clash = messy.withColumns({"n": F.lit(1), "form": F.lit("x"), "output": F.lit(1), "name": F.lit(2)})
    assert M.fill_in_middle(clash).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert M.fill_in_middle(clash).count() == messy.count()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \té😀<>PSM\n", max_size=40), st.integers(1, 7))
def test_cuts(text, block):
    data = np.frombuffer(text.encode(), np.uint8)
    cuts, own = M.Cuts(data, block), UNITS.findall(text)
    assert cuts.units == len(own)
    for k in range(len(own) + 1):
        before = "".join(own[:k])
        assert cuts.after(k) == (len(before.encode()), len(before))
