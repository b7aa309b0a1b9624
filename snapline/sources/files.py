"""Small control files (manifests, headers) on whatever file system holds the data."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def is_file(spark: SparkSession, path: str) -> bool:
    return exists(spark, path) and _system(spark, path).getFileStatus(_path(spark, path)).isFile()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    stream = _system(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode("utf-8"))


# On these a rename copies, while an upload becomes visible as a whole.
OBJECT_STORES = frozenset({"s3", "s3a", "s3n", "gs", "oss", "cosn", "obs"})


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the old text or the new one: written aside, then renamed over; on an
    object store, uploaded over."""
    home = _system(spark, path).getUri()
    if home.getScheme() in OBJECT_STORES:
        write_text(spark, path, text)
        return
    aside = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, aside, text)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(home, spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, aside), _path(spark, path), options)


def children(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)
