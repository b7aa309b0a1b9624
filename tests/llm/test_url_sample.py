from snapline.llm import urls as U


def test_suffixes_are_counted_over_all_labelled_rows_and_rows_are_drawn_one_by_one(llm, monkeypatch):
    # 150 suffixes of 4 rows each, and one URL with a third of all rows.
    rows = [(f"http://h.s{i % 150}.net/{i}", float(i % 2)) for i in range(600)] + [("http://h.hot.net/", 1.0)] * 300
    labelled = llm.createDataFrame(rows, "url string, blocked double")
    host, path = U.host_and_path("url")
    labelled = U.lexical(labelled.withColumns({"host": host, "path": path}), "url", "host", "path")
    paths = {}
    real = U.scratch
    monkeypatch.setattr(U, "scratch", lambda spark, name: paths.setdefault(name, real(spark, name)))
    U.judge(labelled, labelled, ["url"], limit=90)
    known = {r.s: (r.b, r.k) for r in llm.read.parquet(paths["suffixes"]).collect()}
    assert known["hot.net"] == (300, 300) and len(known) == 151
    assert all(known[f"s{i}.net"] == (4 * (i % 2), 4) for i in range(150))
    sample = llm.read.parquet(paths["labelled"])
    hot = sample.where("path_length = 1").count()
    assert 50 < sample.count() < 140 and 10 < hot < 55
