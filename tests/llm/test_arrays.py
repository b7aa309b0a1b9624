import random

import numpy as np
import pyarrow as pa

from snapline.llm.arrays import LONG_WORD, hash_words, text_bytes, words_of
from snapline.llm.decontaminate import decontaminate
from snapline.llm.names import free
from snapline.llm.repeats import remove_repeats


def test_words_that_polynomials_modulo_a_power_of_two_confuse(llm):
    """The word of the parities of bit sums and its complement."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    assert len(set(words_of(*text_bytes(pa.array([one, other, one]))).hashes.tolist())) == 2
    docs = llm.createDataFrame([(1, other), (2, one)], "doc_id long, text string")
    items = llm.createDataFrame([(1, one)], "item_id long, text string")
    assert {r.doc_id: r.contaminated for r in decontaminate(docs, items).collect()} == {1: False, 2: True}
    half = one[:512].replace("a", "Q").replace("b", "j"), other[:512].replace("a", "Q").replace("b", "j")
    texts = llm.createDataFrame([(i, t) for i, t in enumerate(half)], "doc_id long, text string")
    assert {r.n_removed for r in remove_repeats(texts, window=400).collect()} <= {0}


def test_word_hashes_tell_spans_apart():
    drawn = random.Random(3)
    spans = {"".join(drawn.choice("ab") for _ in range(drawn.choice([1, 2, 7, 8, 9, 15, 16, 17, 40]))) for _ in range(3000)}
    spans |= {"c" * n for n in (LONG_WORD - 1, LONG_WORD, LONG_WORD + 1, LONG_WORD + 9)} | {"", "\0", "\0\0"}
    spans = sorted(spans)
    data = np.frombuffer("".join(spans * 2).encode(), np.uint8)
    end = np.cumsum([len(s) for s in spans * 2])
    h = hash_words(data, end - [len(s) for s in spans * 2], end)
    assert len(set(h.tolist())) == len(spans) and (h[: len(spans)] == h[len(spans) :]).all()


def test_free_names():
    assert free(["a", "_A"], "a") == "__a" and free([], "a") == "a"
