"""A history kept by day: a version is a list of day partitions, and unchanged days are not written again.

    <path>/days.json                                   the current version
    <path>/versions/<id>/days.json                     what that version consists of
    <path>/versions/<id>/part_day=<day>/*.parquet      the days that it wrote

A day's digest is its number of rows and two sums of row hashes, so neither the order of rows nor the
files they came in matter. A build compares digests with the current version's, writes only days that
differ, and refers to the others where they are; nearly all days of a long history are closed. Readers
get a list of folders, so a period opens its days only. Pruning keeps what a kept version refers to.
Where days are small, ``grain="month"`` makes the parts months.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.plans.run import PipelineSpec, build, collect_sources
from snapline.plans.snapshot import COMPRESSION, ContractError, Rules
from snapline.session import passing_shuffles, size_shuffles
from snapline.sources import files

_POINTER, _FOLDER = "days.json", "part_day"
# The folder of rows without a day, as Spark names it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# Signs of a day's text that name its part.
GRAINS = {"day": 10, "month": 7}
_DAY = re.compile(r"\d{4}-\d{2}(-\d{2})?")

Part = dict[str, Any]  # version, rows, digest


def _part(day: str, grain: str) -> Column:
    return F.left(F.col(f"`{day}`").cast("string"), F.lit(GRAINS[grain]))


def _digests(df: DataFrame, day: str, grain: str) -> dict[str, tuple[int, str]]:
    """Rows and digest per day; one row a day reaches the driver."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    total = lambda *seed: F.sum(F.xxhash64(*seed, *columns).cast("decimal(38,0)")).cast("string")
    with passing_shuffles(df.sparkSession):
        found = df.groupBy(_part(day, grain).alias("day")).agg(
            F.count(F.lit(1)).alias("rows"), F.concat_ws(":", total(), total(F.lit(1))).alias("digest")
        ).collect()
    made = {NO_DAY if r["day"] is None else r["day"]: (r["rows"], r["digest"]) for r in found}
    odd = [d for d in made if d != NO_DAY and not _DAY.fullmatch(d)]
    if odd:
        raise ContractError(f"'{odd[0]}' in column '{day}' is no day")
    return made


def _write(df: DataFrame, day: str, grain: str, home: str) -> None:
    parts = df.withColumn(_FOLDER, _part(day, grain))
    # A day is one file; a large one is split into several tasks.
    with passing_shuffles(df.sparkSession):
        parts.hint("rebalance", _FOLDER).write.partitionBy(_FOLDER).option("compression", COMPRESSION).parquet(home)


def _among(day: str, grain: str, days: list[str]) -> Column:
    text = _part(day, grain)
    named = text.isin([d for d in days if d != NO_DAY])
    return named | text.isNull() if NO_DAY in days else named


def read_pointer(spark: SparkSession, path: str, version: str | None = None) -> dict[str, Any] | None:
    place = f"{path}/versions/{version}/{_POINTER}" if version else f"{path}/{_POINTER}"
    return json.loads(files.read_text(spark, place)) if files.exists(spark, place) else None


def write_days(df: DataFrame, path: str, day: str, rules: Rules = Rules(), grain: str = "day") -> dict[str, Any]:
    """Make ``df`` the current version, writing only days that differ from the version before.

    The first build, or one whose columns differ, writes all days and takes the digests from what it
    wrote; any other computes ``df`` for the digests and, restricted to the changed days, once more.
    On a failure the version before stays current.
    """
    spark = df.sparkSession
    rules.check_columns(df)
    before = read_pointer(spark, path) or {}
    schema = df.schema.json()
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    home = f"{path}/versions/{version}"
    old: dict[str, Part] = before.get("parts", {}) if (before.get("schema"), before.get("day"), before.get("grain")) == (schema, day, grain) else {}
    try:
        if old:
            now = _digests(df, day, grain)
            changed = [d for d, (rows, digest) in now.items() if d not in old or (old[d]["rows"], old[d]["digest"]) != (rows, digest)]
            if changed:
                few = df.where(_among(day, grain, changed)) if len(changed) < len(now) else df
                _write(few, day, grain, home)
                written = _digests(_opened(spark, df.schema, [f"{home}/{_FOLDER}={d}" for d in changed]), day, grain)
                if written != {d: now[d] for d in changed}:
                    raise ContractError("the data changed while it was written")
        else:
            _write(df, day, grain, home)
            folders = [f"{home}/{name}" for name in files.children(spark, home) if name.startswith(_FOLDER)]
            now = _digests(_opened(spark, df.schema, folders), day, grain)
            changed = list(now)
        rules.check_rows(sum(rows for rows, _ in now.values()))
    except Exception:
        files.delete(spark, home)
        raise
    parts = {d: {"version": version, "rows": rows, "digest": digest} for d, (rows, digest) in now.items()}
    parts |= {d: old[d] for d in now if d not in changed}
    pointer = {
        "generated_at": datetime.now(timezone.utc).isoformat(), "version": version, "day": day, "grain": grain, "schema": schema,
        "row_count": sum(rows for rows, _ in now.values()), "written": sorted(changed), "parts": parts,
        "published": [*before.get("published", []), version],
    }
    files.write_text(spark, f"{home}/{_POINTER}", json.dumps(pointer))
    files.replace_text(spark, f"{path}/{_POINTER}", json.dumps(pointer))
    return pointer


def _opened(spark: SparkSession, schema: T.StructType, folders: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_days(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None, version: str | None = None
) -> DataFrame:
    """The current or a named version; of days from ``first`` to ``last`` only the folders that hold them are opened."""
    pointer = read_pointer(spark, path, version)
    if pointer is None:
        raise ValueError(f"nothing has been written to {path}")
    inside = lambda d: first is None and last is None or d != NO_DAY and (first or d)[: len(d)] <= d <= (last or d)[: len(d)]
    folders = [f"{path}/versions/{p['version']}/{_FOLDER}={d}" for d, p in sorted(pointer["parts"].items()) if inside(d)]
    rows = _opened(spark, T.StructType.fromJson(json.loads(pointer["schema"])), folders)
    text = F.col(f"`{pointer['day']}`").cast("string")
    for bound, test in ((first, text >= F.lit(first)), (last, text <= F.lit(last))):
        rows = rows if bound is None else rows.where(test)
    return rows


def prune_days(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Keep the newest ``keep`` published versions readable; delete every day folder that none of them
    refers to, and what failed builds have left. Returns the folders that went."""
    pointer = read_pointer(spark, path)
    published = pointer["published"]
    kept = published[max(0, len(published) - max(keep, 1)) :]
    needed = {(p["version"], d) for v in kept for d, p in read_pointer(spark, path, v)["parts"].items()}
    gone = []
    for version in files.children(spark, f"{path}/versions"):
        home = f"{path}/versions/{version}"
        own = {d for v, d in needed if v == version}
        if not own and version not in kept:
            files.delete(spark, home)
            gone.append(version)
            continue
        for name in files.children(spark, home):
            if name.startswith(f"{_FOLDER}=") and name.partition("=")[2] not in own:
                files.delete(spark, f"{home}/{name}")
                gone.append(f"{version}/{name}")
    files.replace_text(spark, f"{path}/{_POINTER}", json.dumps({**pointer, "published": kept}))
    return gone


def run_days(
    spark: SparkSession, spec: PipelineSpec, path: str, day: str = "entry_date", grain: str = "day",
    made: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, Any]:
    """Build a pipeline's result, changed by ``made`` if given, and keep it by day."""
    size_shuffles(spark, *[s.path for s in spec.sources if s.path])
    df = build(spec, collect_sources(spark, spec))
    return write_days(made(df) if made else df, path, day, spec.rules, grain)
