"""Deterministic sharded WARC archives of web pages, and reading them back.

Pages get a record number and their digests in a staged table, in one pass. Which records revisit
which is decided from digests and ids alone: per payload the largest page id, counted up before the
exchange, so a payload that a third of all pages share is no large group. The decisions travel as
small rows of their own: they are range-sorted together with the records, by page id, url and record
number, and arrive right before the record that they are about. So the pages' contents are exchanged
once, no join carries them, and a page id that very many rows share is split by its record numbers.

Each sorted part is written as files of about ``file_bytes`` compressed bytes, one gzip member a
record. Headers, record ids and digests are made anew from the page alone, dates are a parameter,
and gzip carries no time, so the same table gives the same records. A task writes under a temporary
name of its own; only the manifest rows of the attempt that Spark accepts are kept, and the files
they name are then moved to their final names, which can be repeated any number of times. Files of
lost or repeated attempts are never named by a manifest and go with the temporary folder. An archive
counts as written once its manifest, which also has each file's size, records and SHA-256, is there.

Defined results: a null html is an empty payload; a null url has no target; line ends in a url are
percent-encoded; a null page id is less than any other; of rows with the same payload and page id,
the first in the archive (by url, then record number) is the response; payloads of fewer bytes than
``least`` are all responses; payloads of any length are written whole; an empty table gives an
archive without files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.operators.joins import spread_join
from snapline.session import scratch

FILE_BYTES, LEAST = 256 << 20, 0
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6
READ_BYTES = 1 << 20
# Fixed values.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_FROM, BASE32_TO = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_MANIFEST = "temporary string, name string, records long, responses long, bytes long, sha256 string"
_RECORD = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def payload_digest(payload: str) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits make four of base 32."""
    digest = F.sha1(F.col(payload))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), BASE32_FROM, BASE32_TO)


def staged(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """Write ``row, page_id, url, payload, bytes, digest``: record numbers must not change any more."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "*", F.octet_length("payload").cast("long").alias("bytes"), payload_digest("payload").alias("digest")
    )
    path = scratch(spark, "pages")
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def revisits(records: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, row, to_id, to_url, to_row`` of the records that repeat another's payload."""
    index = records.where(F.col("bytes") >= least).select("row", "page_id", "url", "digest", "bytes")
    # The largest page id, then the first in the archive: null urls sort first.
    rank = F.struct(F.col("page_id").isNotNull().alias("has_id"), "page_id")
    largest = index.groupBy("digest", "bytes").agg(F.max(rank).alias("top"), F.count("*").alias("copies")).where("copies > 1")
    largest = largest.select(F.col("digest").alias("d"), F.col("bytes").alias("b"), F.col("top.page_id").alias("to_id"))
    shared = spread_join(index, largest, [("digest", "d"), ("bytes", "b")], "inner")
    first = F.min(F.struct(F.col("url").isNotNull().alias("has_url"), "url", "row")).alias("first")
    chosen = shared.where(F.col("page_id").eqNullSafe(F.col("to_id"))).groupBy("digest", "bytes").agg(first)
    chosen = chosen.select(F.col("digest").alias("d"), F.col("bytes").alias("b"), F.col("first.url").alias("to_url"), F.col("first.row").alias("to_row"))
    return spread_join(shared, chosen, [("digest", "d"), ("bytes", "b")], "inner").where("row <> to_row").select(
        "page_id", "url", "row", "to_id", "to_url", "to_row"
    )


def _record_id(page_id: str | None, url: str | None, row: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url}\n{row}").urn


def _target(url: str) -> str:
    """A url without signs that would end a header line."""
    return "".join(quote(c) if c < " " or c == "\x7f" else c for c in url)


def record_bytes(page_id: str | None, url: str | None, row: int, payload: bytes, digest: str, size: int, to: tuple | None, date: str = DATE) -> bytes:
    """One record; with ``to`` (page id, url and row of the response) a revisit, which has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if to else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if to else 'response'}", f"WARC-Record-ID: <{_record_id(page_id, url, row)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_target(url)}")
    if page_id is not None:
        lines.append(f"Page-ID: {_target(page_id)}")
    if to:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{_record_id(*to)}>", f"WARC-Refers-To-Date: {date}"]
        lines += [f"WARC-Refers-To-Target-URI: {_target(to[1])}"] if to[1] is not None else []
        lines += [f"Refers-To-Page-ID: {_target(to[0])}"] if to[0] is not None else []
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{block_digest}", "Content-Type: application/http; msgtype=response"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Shard:
    """The open file of a task, under a temporary name."""

    def __init__(self, base: str, part: int):
        self.system, self.base = fs.FileSystem.from_uri(base)
        self.own, self.part, self.number, self.file = uuid.uuid4().hex, part, 0, None

    def add(self, raw: bytes, response: bool) -> None:
        if self.file is None:
            self.temporary = f"_temporary/{self.own}/{self.number:05d}.warc.gz"
            path = f"{self.base}/{self.temporary}"
            self.system.create_dir(path.rpartition("/")[0], recursive=True)
            self.file, self.digest = self.system.open_output_stream(path, compression=None), hashlib.sha256()
            self.records = self.responses = self.bytes = 0
        member = _member(raw)
        self.file.write(member)
        self.digest.update(member)
        self.records += 1
        self.responses += response
        self.bytes += len(member)

    def closed(self) -> dict | None:
        if self.file is None:
            return None
        self.file.close()
        self.file = None
        name = f"part-{self.part:05d}-{self.number:05d}.warc.gz"
        self.number += 1
        return {"temporary": self.temporary, "name": name, "records": self.records, "responses": self.responses, "bytes": self.bytes, "sha256": self.digest.hexdigest()}


def _uri(path: str) -> str:
    """A path that a filesystem library takes; plain paths are local ones."""
    path = path.rstrip("/")
    if path.startswith("file:"):
        return "file://" + "/" + path.removeprefix("file:").lstrip("/")
    return path


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    file_bytes: int = FILE_BYTES, least: int = LEAST, date: str = DATE,
) -> DataFrame:
    """Write the archive below ``path``, a folder that all executors share; its manifest:
    ``name, records, responses, bytes, sha256`` per file."""
    spark, base = pages.sparkSession, _uri(path)
    records = staged(pages, id_col, url_col, payload_col)
    none = F.lit(None)
    told = revisits(records, least).select(
        "page_id", "url", "row", F.lit(0).alias("kind"), none.cast("binary").alias("payload"), none.cast("long").alias("bytes"), none.cast("string").alias("digest"),
        F.struct(F.col("to_id").cast("string").alias("id"), F.col("to_url").alias("url"), F.col("to_row").alias("row")).alias("to"),
    )
    plain = records.select("page_id", "url", "row", F.lit(1).alias("kind"), "payload", "bytes", "digest", none.cast(told.schema["to"].dataType).alias("to"))
    key = ("page_id", "url", "row")
    ordered = told.union(plain).repartitionByRange(*key).sortWithinPartitions(*key, "kind").withColumn("page_id", F.col("page_id").cast("string"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, to, made = _Shard(base, TaskContext.get().partitionId()), None, []
        for batch in batches:
            for page_id, url, row, kind, payload, size, digest, told_to in zip(*(c.to_pylist() for c in batch.columns)):
                if not kind:
                    to = (told_to["id"], told_to["url"], told_to["row"])
                    continue
                shard.add(record_bytes(page_id, url, row, payload, digest, size, to, date), to is None)
                to = None
                if shard.bytes >= file_bytes:
                    made.append(shard.closed())
        made += [last] if (last := shard.closed()) else []
        yield pa.RecordBatch.from_pylist(made, pa.schema([
            ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("responses", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()),
        ]))

    found = scratch(spark, "manifest")
    ordered.mapInArrow(write, _MANIFEST).write.parquet(found)
    written = spark.read.schema(_MANIFEST).parquet(found)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            system, top = fs.FileSystem.from_uri(base)
            for temporary, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if system.get_file_info(f"{top}/{temporary}").type == fs.FileType.File:  # else an earlier attempt moved it
                    system.move(f"{top}/{temporary}", f"{top}/{name}")
            yield batch.drop_columns(["temporary"])

    manifest = written.mapInArrow(move, _MANIFEST.partition(", ")[2])
    manifest.write.parquet(f"{path.rstrip('/')}/manifest")
    system, top = fs.FileSystem.from_uri(base)
    if system.get_file_info(f"{top}/_temporary").type == fs.FileType.Directory:
        system.delete_dir(f"{top}/_temporary")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST.partition(", ")[2]).parquet(f"{path.rstrip('/')}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The contents of the gzip members of a stream."""
    unpacker, made = zlib.decompressobj(31), []
    while chunk := stream.read(READ_BYTES):
        while chunk:
            made.append(unpacker.decompress(chunk))
            chunk = unpacker.unused_data if unpacker.eof else b""
            if unpacker.eof:
                yield b"".join(made)
                unpacker, made = zlib.decompressobj(31), []
    if made:
        raise ValueError("the file ends within a record")


def parsed(raw: bytes) -> dict:
    """A record's fields; its digests and lengths are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    made = [fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(), version == "WARC/1.1", end == b"\r\n\r\n"]
    if fields["WARC-Type"] == "response":
        made += [len(payload) == size, digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()]
    if not all(made):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": fields.get("Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "payload_bytes": size,
        "payload_digest": digest, "refers_to": fields.get("Refers-To-Page-ID"), "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def read_warc(spark: SparkSession, path: str, id_type: str = "string", payload: bool = True) -> DataFrame:
    """``page_id, url, record_type, payload_bytes, payload_digest, refers_to`` and the responses' ``payload``
    of an archive: the files that its manifest names, each read as a stream by one task."""
    base = _uri(path)
    schema = _RECORD if payload else _RECORD.rpartition(", ")[0]
    kinds = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(k, pa.string())) for n, k in (f.split() for f in schema.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = fs.FileSystem.from_uri(base)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                made, size = [], 0
                with system.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        record = parsed(raw)
                        made.append({k: record[k] for k in kinds.names})
                        size += len(raw) if payload else 200
                        if size >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(made, kinds)
                            made, size = [], 0
                if made:
                    yield pa.RecordBatch.from_pylist(made, kinds)

    names = read_manifest(spark, path).select("name")
    files = names.repartition(max(1, names.count()))
    found = files.mapInArrow(read, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
