from snapline.llm import decontaminate as D
from tests.llm.conftest import words


def test_a_window_of_many_items_does_not_fill_one_block(llm, monkeypatch):
    shared = words(10, 1)
    items = llm.createDataFrame([(i, shared) for i in range(400)] + [(1000, words(30, 2))], "item_id int, text string")
    docs = llm.createDataFrame([(1, f"some {shared} text"), (2, words(30, 2)), (3, words(50, 3))], "doc_id int, text string")
    want = sorted(map(repr, D.decontaminate(docs, items).collect()))
    windows = D.item_windows(items, 10).cache()
    index = D.build_index(docs, D.scratch(llm, "index"), "doc_id")
    monkeypatch.setattr(D, "BLOCK_WINDOWS", 100)
    sizes = [len(q.items) for q in D._blocks(index, windows)]
    assert sum(sizes) == windows.count() == 421 and max(sizes) < 200
    assert sorted(map(repr, D.decontaminate(docs, items).collect())) == want
