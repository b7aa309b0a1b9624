import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapline.llm import pack as P

T = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def ids(text):
    return np.array(T.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


PARTS = st.lists(st.sampled_from([" ", "  ", "\n", "word", "Wörd", "'s", "n't", ",", "!!", "7", "42", "中", "😀", "\t", " \n", "\r\n", "<|endoftext|>", "×", "́", "a.b", "(x)"]), max_size=14)


@settings(max_examples=300, deadline=None)
@given(PARTS)
def test_ids_equal_the_tokenizers(parts):
    text = "".join(parts)
    assert P.token_bytes(text) == ids(text).tobytes()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=30))
def test_sequences_end_up_full_and_each_token_is_placed_once(lengths):
    room = P.capacities(sum(lengths), 64)
    pieces = list(P.assign(lengths, 64))
    for d, n in enumerate(lengths):
        own = sorted((s, k) for doc, s, k, _, _ in pieces if doc == d)
        assert [s for s, _ in own] == np.concatenate([[0], np.cumsum([k for _, k in own])])[:-1].tolist() and sum(k for _, k in own) == n
    for s, full in enumerate(room):
        own = sorted((o, k) for _, _, k, q, o in pieces if q == s)
        assert sum(k for _, k in own) == full and [o for o, _ in own] == np.concatenate([[0], np.cumsum([k for _, k in own])])[:-1].tolist()
        assert full == 64 or full & (full - 1) == 0


def test_costs_are_more_even_than_in_order():
    lengths = [int(x) for x in np.random.default_rng(1).gamma(1.5, 150, 4000) + 1]
    cost = lambda n: P.LINEAR * n + P.QUADRATIC * n * n
    own = {}
    for _, _, n, s, _ in P.assign(lengths):
        own[s] = own.get(s, 0) + cost(n)
    plain, room = [0.0], P.SEQUENCE
    for n in lengths:
        while n:
            k = min(n, room)
            plain[-1] += cost(k)
            n, room = n - k, room - k
            if not room:
                plain.append(0.0)
                room = P.SEQUENCE
    full = [own[s] for s, c in enumerate(P.capacities(sum(lengths))) if c == P.SEQUENCE]
    assert np.std(full) < np.std(plain[:-1])


def test_table(messy, nothing):
    got = P.pack(messy, bucket=1000).toPandas()
    texts = {}
    for r in messy.collect():
        texts.setdefault(r.doc_id, []).append(np.append(ids(r.text), np.uint32(1)).astype("<u4"))
    assert got.length.sum() == sum(len(t) for own in texts.values() for t in own)
    for r in got.itertuples():
        doc = None if r.doc_id != r.doc_id else int(r.doc_id)
        assert any(len(t) == r.doc_tokens and zlib.crc32(t[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for t in texts[doc])
    total = got.groupby("sequence_id").length.sum()
    assert total.max() <= 2048 and ((total == 2048) | (total & (total - 1) == 0)).all()
    assert P.pack(nothing).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aZthéÿŁǃßøÀɏ·ªµ", min_size=1, max_size=12), min_size=1, max_size=6))
def test_words_of_latin_letters_have_the_tokenizers_ids(parts):
    text = " ".join(parts)
    assert P.token_bytes(text) == ids(text).tobytes()


def test_words_of_letters_go_to_the_model_at_once(monkeypatch):
    """What took most of the CPU seconds: the whole tokenizer for every word that is not remembered."""
    monkeypatch.setattr(P, "_memory", {})
    P.token_bytes("a b")
    first, rest, _ = P._memory[P.TOKENIZER]
    whole = []

    class Counted:
        def encode(self, text, **options):
            whole.append(text)
            return T.encode(text, **options)

    first.tokenizer = rest.tokenizer = Counted()
    text = "Thonouen réion, an Wörd übermorgen x7"
    assert P.token_bytes(text) == ids(text).tobytes()
    assert whole == [",", " x7"]
