"""One build: read, combine, check, write, publish; or keep the last good snapshot."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from snapline.operators.metrics import normalize_metrics, sample_series, union_all
from snapline.operators.pushdown import restrict_to_keys
from snapline.plans.snapshot import (
    ContractError, Manifest, Rules, mark_stale, prune_versions, read_manifest, write_snapshot,
)
from snapline.session import size_shuffles
from snapline.sources.readers import SourceSpec, read_source

log = logging.getLogger(__name__)

Assemble = Callable[[Mapping[str, DataFrame]], DataFrame]
Export = Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]


@dataclass(frozen=True)
class PipelineSpec:
    """``assemble`` joins the sources around ``driver``; without it they are unioned by name.

    ``export`` says which source tables are published beside the snapshot.
    """

    name: str
    sources: tuple[SourceSpec, ...]
    driver: str | None = None
    assemble: Assemble | None = None
    export: Export | None = None
    rules: Rules = Rules()
    encrypt: tuple[str, ...] = ()
    versions: dict[str, str] = field(default_factory=dict)


def collect_sources(spark: SparkSession, spec: PipelineSpec) -> dict[str, DataFrame]:
    """All sources by name, lazily; those with ``keys`` are restricted to the driver."""
    frames = {source.name: read_source(spark, source) for source in spec.sources}
    if spec.assemble is None:
        return frames
    if spec.driver is None:
        raise ContractError("an assembly needs a driver")
    if spec.driver not in frames:
        raise ContractError(f"driver '{spec.driver}' is not among the sources")
    driver = frames[spec.driver]
    for source in spec.sources:
        if source.keys and source.name != spec.driver:
            column, driver_column = source.keys
            if driver_column not in driver.columns:
                raise ContractError(f"source '{source.name}': the driver has no column '{driver_column}'")
            frames[source.name] = restrict_to_keys(frames[source.name], column, driver, driver_column)
    return frames


def build(spec: PipelineSpec, frames: Mapping[str, DataFrame]) -> DataFrame:
    combined = spec.assemble(frames) if spec.assemble else union_all(list(frames.values()))
    return normalize_metrics(combined)


def run_sample(
    spark: SparkSession, catalogue: DataFrame, path: str, start_day: str, days: int = 60
) -> Manifest:
    """Publish a synthetic metric snapshot, to try readers without any source."""
    series = normalize_metrics(sample_series(catalogue, start_day, days))
    return write_snapshot(series, path, source_versions={"mode": "sample"})


def run_pipeline(
    spark: SparkSession, spec: PipelineSpec, path: str, key: Column | None = None, keep: int | None = None
) -> Manifest:
    """Build and publish. On any failure the previous version stays current and the
    returned manifest is stale and names the error.

    Shuffles are sized by the sources' files. Published source tables are written first and the
    result is assembled from them. ``keep`` is how many published versions stay on disk.
    """
    try:
        size_shuffles(spark, *[s.path for s in spec.sources if s.path])
        frames = collect_sources(spark, spec)
        manifest = write_snapshot(
            lambda written: build(spec, {**frames, **written}),
            path,
            sources=spec.export(frames) if spec.export else None,
            rules=spec.rules,
            source_versions={"pipeline": spec.name, **spec.versions},
            encrypt=spec.encrypt,
            key=key,
            spark=spark,
        )
    except Exception as error:
        log.exception("build of %s failed", spec.name)
        return mark_stale(spark, path, str(error))
    if keep is not None:
        prune_versions(spark, path, keep)
        return read_manifest(spark, path)
    return manifest
