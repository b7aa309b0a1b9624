import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapline.llm import warc as W

SCHEMA = "page_id long, url string, html string, row int, digest string, kind int, payload int"


def frame(llm, rows):
    return llm.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, "http://a/3", "y"), (4, None, None), (5, "http://a/5\r\nX: 1", ""),
    (6, "http://a/6", "é中😀\r\n\r\nWARC/1.1\r\n"), (None, "http://a/7", "y"), (None, None, "z"), (9, "http://a/9", "b" * 3_000_000),
    (2, "http://a/2", "<p>x</p>"), (7, "http://b", "Content-Length: 5\r\n\r\n"), (0, "http://z", "y"),
]


@pytest.fixture
def archive(llm, tmp_path):
    path = f"file://{tmp_path}/out"
    return path, W.write_warc(frame(llm, ROWS), path, file_bytes=400)


def test_round_trip(llm, archive):
    path, manifest = archive
    got = W.read_warc(llm, path, "bigint").collect()
    assert len(got) == len(ROWS)
    plain = lambda rows: sorted(map(repr, rows))
    assert plain((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == plain((i, len((h or "").encode()), digest(h)) for i, _, h in ROWS)
    # One response for each payload: the largest page id; all others name it.
    top = {}
    for i, _, h in ROWS:
        top[digest(h)] = max(top.get(digest(h), -1), -1 if i is None else i)
    for d, i in top.items():
        own = [r for r in got if r.payload_digest == d]
        responses = [r for r in own if r.record_type == "response"]
        assert len(responses) == 1 and responses[0].page_id == (None if i < 0 else i) and responses[0].refers_to is None
        assert digest(bytes(responses[0].payload).decode()) == d
        assert {(r.refers_to, r.payload) for r in own if r.record_type == "revisit"} <= {(responses[0].page_id, None)}
    assert {r.url for r in got if r.page_id == 5} == {"http://a/5%0D%0AX: 1"} and {r.url for r in got if r.page_id == 4} == {None}
    rows = manifest.collect()
    assert sum(r.records for r in rows) == len(ROWS) and sum(r.responses for r in rows) == len(top) and len(rows) > 2
    folder = Path(path.removeprefix("file://"))
    assert {p.name for p in folder.glob("*.warc.gz")} == {r.name for r in rows} and not (folder / "_temporary").exists()
    for r in rows:
        raw = (folder / r.name).read_bytes()
        assert len(raw) == r.bytes and hashlib.sha256(raw).hexdigest() == r.sha256
        assert gzip.decompress(raw).count(b"WARC-Record-ID: ") == r.records


def test_records_are_in_order_and_the_same_again(llm, archive, tmp_path):
    path, manifest = archive
    again = W.write_warc(frame(llm, ROWS), f"{tmp_path}/again", file_bytes=400)
    assert sorted(manifest.collect()) == sorted(again.collect())
    order = []
    for r in sorted(manifest.collect(), key=lambda r: r.name):
        for raw in W._members(open(f"{tmp_path}/out/{r.name}", "rb")):
            order.append(W.parsed(raw)["page_id"])
    assert order == sorted(order, key=lambda i: (i is not None, int(i or 0)))


def test_files_that_no_manifest_names_are_not_read(llm, archive):
    path, _ = archive
    stray = Path(path.removeprefix("file://")) / "part-99999-00000.warc.gz"
    stray.write_bytes(b"lost")
    assert W.read_warc(llm, path).count() == len(ROWS)


def test_damage_is_found(archive, tmp_path):
    name = archive[1].first()["name"]
    record = next(W._members(open(f"{tmp_path}/out/{name}", "rb")))
    with pytest.raises(ValueError):
        W.parsed(record.replace(b"200 OK", b"200 KO"))
    with pytest.raises(ValueError):
        list(W._members(open(_half(tmp_path, name), "rb")))


def _half(tmp_path, name):
    raw = (tmp_path / "out" / name).read_bytes()
    (tmp_path / "half").write_bytes(raw[: len(raw) // 2])
    return str(tmp_path / "half")


def test_small_payloads_may_all_be_responses(llm, tmp_path):
    W.write_warc(frame(llm, ROWS), f"{tmp_path}/out", least=2)
    got = W.read_warc(llm, f"{tmp_path}/out", payload=False).collect()
    assert {r.record_type for r in got if r.payload_bytes < 2} == {"response"}
    assert {r.record_type for r in got if r.payload_bytes == 8} == {"response", "revisit"}


def test_empty_table(llm, tmp_path):
    manifest = W.write_warc(frame(llm, []), f"{tmp_path}/out")
    assert manifest.count() == 0 and W.read_warc(llm, f"{tmp_path}/out").count() == 0


def test_large_groups_of_copies(llm, tmp_path):
    many = llm.range(3000).select(
        F.col("id").alias("page_id"), F.lit("http://x").alias("url"), F.when(F.col("id") % 3 > 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("html")
    )
    W.write_warc(many, f"{tmp_path}/out")
    got = W.read_warc(llm, f"{tmp_path}/out", "bigint", payload=False)
    found = got.groupBy("record_type").agg(F.count("*").alias("n"), F.max("refers_to").alias("to")).collect()
    assert {(r.record_type, r.n, r.to) for r in found} == {("response", 1001, None), ("revisit", 1999, 2999)}
