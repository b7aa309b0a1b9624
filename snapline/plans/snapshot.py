"""Versioned snapshots: a folder per version and one manifest that names the current one.

    <path>/manifest.json
    <path>/versions/<id>/data/*.parquet
    <path>/versions/<id>/sources/<name>/*.parquet
    <path>/versions/<id>/sketches/*.parquet       distinct counts per day that merge, if asked for
    <path>/versions/<id>/trigrams/*.parquet       which files may hold a search term, if asked for

Readers follow the manifest, so they never see a half-written version, and nothing is
moved: replacing the manifest is the whole publication.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapline.operators.grid import grid_search
from snapline.operators.profile import missing_columns
from snapline.operators.protect import decrypt_columns, encrypt_columns
from snapline.operators.sketches import day_sketches
from snapline.operators.trigrams import file_trigrams, indexed_search
from snapline.sources import files

log = logging.getLogger(__name__)

# Fixed values.
MANIFEST_ZONE = timezone(timedelta(hours=5))
COMPRESSION = "zstd"
OK, STALE = "ok", "stale"

SOURCE_JOBS = 4


class ContractError(ValueError):
    """The result breaks the snapshot contract."""


@dataclass(frozen=True)
class Rules:
    """The contract: columns that must exist and row bounds (no upper bound by default)."""

    expected_columns: tuple[str, ...] = ()
    min_rows: int = 0
    max_rows: int | None = None

    def check_columns(self, df: DataFrame) -> None:
        missing = missing_columns(df, self.expected_columns)
        if missing:
            raise ContractError(f"the result lacks {', '.join(missing)}")

    def check_rows(self, n: int) -> None:
        if n < self.min_rows:
            raise ContractError(f"{n} rows, but at least {self.min_rows} are promised")
        if self.max_rows is not None and n > self.max_rows:
            raise ContractError(f"{n} rows, but at most {self.max_rows} are promised")


@dataclass
class Manifest:
    generated_at: str | None = None
    version: str | None = None
    row_count: int = 0
    columns: list[dict[str, str]] = field(default_factory=list)
    source_versions: dict[str, str] = field(default_factory=dict)
    source_tables: list[str] = field(default_factory=list)
    source_tables_info: list[dict[str, Any]] = field(default_factory=list)
    encrypted: bool = False
    encrypted_columns: dict[str, dict[str, str]] = field(default_factory=dict)
    status: str = OK
    error: str | None = None
    stale_at: str | None = None
    # The day column and the columns of the distinct-count sketches; whether there is a search index.
    sketches: dict[str, Any] = field(default_factory=dict)
    search_index: bool = False
    # Versions that were current once, oldest first; what is on disk besides them is unfinished.
    published: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        kept = {k: v for k, v in asdict(self).items() if v is not None}
        return json.dumps(kept, ensure_ascii=False, indent=2)

    @property
    def state(self) -> tuple[Any, ...]:
        """What a poller compares: going stale changes it, too."""
        return (self.generated_at, self.status, self.stale_at)


def _now() -> str:
    return datetime.now(MANIFEST_ZONE).isoformat()


def _manifest_path(path: str) -> str:
    return f"{path}/manifest.json"


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    return Manifest(**json.loads(files.read_text(spark, _manifest_path(path))))


def _write(df: DataFrame, path: str) -> int:
    """Write and count in one job. The count belongs to the writing tasks, which count once
    even if some are repeated; below a sort it would also see the sort's sampling pass."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", COMPRESSION).parquet(path)
    return seen.get["n"]


Build = Callable[[Mapping[str, DataFrame]], DataFrame]


def write_snapshot(
    df: DataFrame | Build,
    path: str,
    sources: Mapping[str, DataFrame] | None = None,
    rules: Rules = Rules(),
    source_versions: Mapping[str, str] | None = None,
    encrypt: Sequence[str] = (),
    key: Column | None = None,
    spark: SparkSession | None = None,
    sketch: tuple[str, Sequence[str]] | None = None,
    search_index: bool = False,
) -> Manifest:
    """Write a new version, check it, then make it current. On failure it is deleted again and
    the current one is untouched; a source table that cannot be written is left out.

    ``df`` may be a function of the source tables: they are written first, once, and what it
    gets are the written ones, so the data and the published sources show the same state.
    The columns named in ``encrypt`` are encrypted wherever they occur. ``sketch`` names a day column
    and columns whose distinct counts are kept as sketches; ``search_index`` asks for the files' trigrams.
    Both are made from the written data, so encrypted columns have neither.
    """
    spark = spark or (df.sparkSession if isinstance(df, DataFrame) else SparkSession.active())
    if isinstance(df, DataFrame):
        rules.check_columns(df)
    if encrypt and key is None:
        raise ContractError("encryption is asked for, but there is no key")
    hidden: dict[str, dict[str, str]] = {}

    def protected(name: str, frame: DataFrame) -> DataFrame:
        found = {c: frame.schema[c].dataType.simpleString() for c in encrypt if c in frame.columns}
        if not found:
            return frame
        hidden[name] = found
        return encrypt_columns(frame, list(found), key)

    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    home = f"{path}/versions/{version}"

    def publish(item: tuple[str, DataFrame]) -> dict[str, Any] | None:
        name, source = item
        try:
            return {"name": name, "row_count": _write(protected(name, source), f"{home}/sources/{name}")}
        except Exception as error:  # unreadable files arrive as errors of many kinds
            log.warning("source table %s left out: %s", name, error)
            hidden.pop(name, None)
            files.delete(spark, f"{home}/sources/{name}")
            return None

    try:
        # The jobs are independent; side by side, the end of one does not idle the cluster.
        with ThreadPoolExecutor(SOURCE_JOBS) as jobs:
            written = [done for done in jobs.map(publish, (sources or {}).items()) if done]
        if not isinstance(df, DataFrame):
            df = df({s["name"]: _open_part(spark, f"{home}/sources/{s['name']}", hidden.get(s["name"]), key) for s in written})
            rules.check_columns(df)
        row_count = _write(protected("data", df), f"{home}/data")
        rules.check_rows(row_count)
        clear = spark.read.parquet(f"{home}/data").drop(*hidden.get("data", {}))
        sketched = [c for c in sketch[1] if c in clear.columns] if sketch and sketch[0] in clear.columns else []
        if sketched:
            day_sketches(clear, sketch[0], sketched).write.option("compression", COMPRESSION).parquet(f"{home}/sketches")
        if search_index:
            file_trigrams(clear).write.option("compression", COMPRESSION).parquet(f"{home}/trigrams")
    except Exception:
        files.delete(spark, home)
        raise
    known = files.exists(spark, _manifest_path(path))
    before = read_manifest(spark, path) if known else Manifest()
    manifest = Manifest(
        generated_at=_now(),
        version=version,
        row_count=row_count,
        columns=[{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields],
        source_versions=dict(source_versions or {}),
        source_tables=[s["name"] for s in written],
        source_tables_info=written,
        encrypted=bool(hidden),
        encrypted_columns=hidden,
        sketches={"day": sketch[0], "columns": sketched} if sketched else {},
        search_index=search_index,
        published=[*(before.published or ([before.version] if before.version else [])), version],
    )
    files.replace_text(spark, _manifest_path(path), manifest.to_json())
    return manifest


def mark_stale(spark: SparkSession, path: str, error: str) -> Manifest:
    """Keep the last good version current and say that it is old."""
    known = files.exists(spark, _manifest_path(path))
    manifest = read_manifest(spark, path) if known else Manifest()
    manifest.status, manifest.error, manifest.stale_at = STALE, error, _now()
    files.replace_text(spark, _manifest_path(path), manifest.to_json())
    return manifest


def prune_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` published versions, never the current one, and what
    failed builds have left."""
    manifest = read_manifest(spark, path)
    published = manifest.published or [manifest.version]
    kept = {*published[max(0, len(published) - keep) :], manifest.version}
    old = [v for v in files.children(spark, f"{path}/versions") if v not in kept]
    for version in old:
        files.delete(spark, f"{path}/versions/{version}")
    manifest.published = [v for v in published if v in kept]
    files.replace_text(spark, _manifest_path(path), manifest.to_json())
    return old


def _open_part(spark: SparkSession, place: str, hidden: Mapping[str, str] | None, key: Column | None) -> DataFrame:
    df = spark.read.parquet(place)
    if not hidden or key is None:
        return df
    clear = decrypt_columns(df, list(hidden), key)
    return clear.withColumns({c: F.col(c).cast(kind) for c, kind in hidden.items()})


def _open(spark: SparkSession, path: str, manifest: Manifest, name: str, key: Column | None) -> DataFrame:
    part = "data" if name == "data" else f"sources/{name}"
    return _open_part(spark, f"{path}/versions/{manifest.version}/{part}", manifest.encrypted_columns.get(name), key)


def read_snapshot(spark: SparkSession, path: str, key: Column | None = None) -> DataFrame:
    """The current version; without ``key`` its encrypted columns stay binary."""
    return _open(spark, path, read_manifest(spark, path), "data", key)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """``day, column_name, row_count, nulls, sketch`` of the current version."""
    manifest = read_manifest(spark, path)
    if not manifest.sketches:
        raise ContractError("the snapshot was written without sketches")
    return spark.read.parquet(f"{path}/versions/{manifest.version}/sketches")


def search_snapshot(spark: SparkSession, path: str, term: str) -> DataFrame:
    """``grid_search`` of the current version; with a search index only files that may hold the term are opened."""
    manifest = read_manifest(spark, path)
    data = _open(spark, path, manifest, "data", None)
    # Encrypted cells are not in the index, but their bytes count as text.
    if not manifest.search_index or manifest.encrypted_columns.get("data"):
        return grid_search(data, term)
    return indexed_search(data, spark.read.parquet(f"{path}/versions/{manifest.version}/trigrams"), term)


def snapshot_views(
    spark: SparkSession, path: str, key: Column | None = None
) -> dict[str, DataFrame]:
    """The snapshot as view ``data`` and its source tables under their names; a source
    table that cannot be read is skipped."""
    manifest = read_manifest(spark, path)
    frames = {"data": _open(spark, path, manifest, "data", key)}
    frames["data"].createOrReplaceTempView("data")
    for name in manifest.source_tables:
        try:
            frames[name] = _open(spark, path, manifest, name, key)
            frames[name].createOrReplaceTempView(name)
        except Exception as error:
            log.warning("source table %s not loaded: %s", name, error)
    return frames


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of each frame; Parquet answers from its footers."""
    counts: Sequence[DataFrame] = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
