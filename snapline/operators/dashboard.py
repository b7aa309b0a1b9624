"""KPI panels, bars, lines and filter options over a snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.session import scratch

# Fixed value: the option that stands for "no filter".
ALL = "__all__"


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def agg_expr(df: DataFrame, agg: str, field: str, approximate: bool = False) -> Column:
    """The aggregate of a column of ``df`` as DOUBLE; an unknown name means sum.

    Sums of integers are taken in a wider type, so that they do not overflow. Each exact distinct count multiplies the rows that are aggregated; with
    ``approximate`` it becomes a sketch and the panel stays one pass of constant size.
    """
    column = _named(field)
    if agg == "count":
        value = F.count(column)
    elif agg == "count_distinct" and approximate:
        value = F.approx_count_distinct(column)
    elif agg == "count_distinct":
        value = F.count_distinct(column)
    elif agg == "avg":
        value = F.avg(column)
    else:
        whole = isinstance(df.schema[field].dataType, T.IntegralType)
        value = F.sum(column.cast("decimal(38,0)") if whole else column)
    return value.cast("double")


def equality_filters(df: DataFrame, filters: Mapping[str, Any] | None) -> DataFrame:
    """All ``field = value`` at once; an empty value or ``__all__`` filters nothing."""
    for field, value in (filters or {}).items():
        if value is None or value == "" or value == ALL:
            continue
        df = df.where(_named(field) == F.lit(value).cast(df.schema[field].dataType))
    return df


def kpis(
    df: DataFrame,
    specs: Sequence[Mapping[str, str]],
    filters: Mapping[str, Any] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """One row ``k0, k1, ...``; every aggregate comes from one pass, NULL shows as 0."""
    values = [
        F.coalesce(agg_expr(df, s["agg"], s["field"], approximate), F.lit(0.0)).alias(f"k{i}")
        for i, s in enumerate(specs)
    ]
    return equality_filters(df, filters).agg(*values)


def bar(
    df: DataFrame,
    x: str,
    y: str,
    agg: str,
    limit: int | None = None,
    filters: Mapping[str, Any] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """``x, y`` by falling y; a NULL x is a bar of its own; ``limit`` makes it a top-n."""
    rows = equality_filters(df, filters).groupBy(_named(x).alias("x")).agg(agg_expr(df, agg, y, approximate).alias("y"))
    return _ranked(rows, limit)


def _ranked(rows: DataFrame, limit: int | None) -> DataFrame:
    rows = rows.orderBy(F.col("y").desc_nulls_last(), F.col("x").asc_nulls_last())
    return rows.limit(limit) if limit else rows


def line(
    df: DataFrame,
    x: str,
    y: str,
    agg: str,
    series: str | None = None,
    filters: Mapping[str, Any] | None = None,
    dense: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """``x, s, y`` by x; ``dense`` shows 0 for NULL and for every observed x a series lacks."""
    name = _named(series) if series else F.lit("all")
    rows = (
        equality_filters(df, filters)
        .groupBy(_named(x).alias("x"), name.alias("s"))
        .agg(agg_expr(df, agg, y, approximate).alias("y"))
    )
    return _drawn(rows, dense, series)


def _drawn(rows: DataFrame, dense: bool, series: str | None) -> DataFrame:
    if dense and series:
        rows = densify(rows)
    elif dense:  # a single series lacks no x
        rows = rows.withColumn("y", F.coalesce("y", F.lit(0.0)))
    return rows.orderBy(F.col("x").asc_nulls_last(), F.col("s").asc_nulls_last())


# Values of the x axis that one row holds, about.
AXIS_BLOCK = 10_000


def densify(points: DataFrame) -> DataFrame:
    """Every observed x with every observed series, missing and NULL values as 0.

    The result is the product of the two by definition. The x axis is cut into blocks of about
    ``AXIS_BLOCK`` values by their hash; a series becomes one row a block, meets the blocks by their
    number and unfolds them there, so neither the axis nor a series is ever one row or one task.
    The points are then looked up by a shuffled join.
    """
    xs = points.select(F.struct("x").alias("gx"), F.xxhash64("x").alias("hash")).distinct()
    blocks = F.ceil(xs.agg(F.count(F.lit(1))).scalar() / F.lit(AXIS_BLOCK)).cast("int")
    axis = xs.groupBy(F.pmod("hash", F.greatest(blocks, F.lit(1))).cast("int").alias("block")).agg(F.collect_list("gx").alias("gxs"))
    names = points.select("s").distinct().select(F.col("s").alias("gs"), F.explode(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1)).alias("at"))
    grid = names.join(axis, F.col("at") == F.col("block")).select("gs", F.explode("gxs").alias("gx")).select("gs", F.col("gx.x").alias("gx"))
    same = F.col("gx").eqNullSafe(F.col("x")) & F.col("gs").eqNullSafe(F.col("s"))
    return grid.join(points, same, "left").select(
        F.col("gx").alias("x"), F.col("gs").alias("s"), F.coalesce("y", F.lit(0.0)).alias("y")
    )


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values for a dashboard filter."""
    return df.where(_named(column).isNotNull()).select(_named(column)).distinct().orderBy(_named(column))


class Panels:
    """The groups of all panels of a dashboard from one pass over its rows.

    Each panel needs the groups of a set of columns: none for KPIs, a bar's x, a line's x and series,
    a filter's field; an exact distinct count needs those of its field beside them and is counted from
    there. So all panels are one aggregation by grouping sets with partial results, of which each
    panel reads its own set. Filters are a condition inside the aggregates, as the lists of filter
    options show all rows.
    """

    def __init__(self, df: DataFrame, spec: Mapping[str, Any], filters: Mapping[str, Any] | None = None, approximate: bool = False):
        self.df, self.spec, self.approximate = df, spec, approximate
        self.keys: list[str] = []
        self.sets: list[frozenset[str]] = []
        self.measures: list[tuple[str, str]] = []
        for f in spec.get("filters", []):
            self._need([f["field"]])
        for k in spec.get("kpis") or []:
            self._need([], k["agg"], k["field"])
        for w in spec.get("widgets", []):
            self._need(self._by(w), w["agg"], w["y"])
        self.table = self._grouped(filters) if self.sets else None

    @staticmethod
    def _by(widget: Mapping[str, Any]) -> list[str]:
        return [widget["x"], *([widget["series"]] if widget.get("series") and widget["type"] == "line" else [])]

    def _counted(self, agg: str) -> bool:
        """Is the aggregate counted from groups of its field?"""
        return agg == "count_distinct" and not self.approximate

    def _need(self, by: Sequence[str], agg: str | None = None, field: str = "") -> None:
        wanted = [*by, field] if agg and self._counted(agg) else list(by)
        self.keys += [c for c in wanted if c not in self.keys]
        if frozenset(wanted) not in self.sets:
            self.sets.append(frozenset(wanted))
        if agg and not self._counted(agg) and (agg, field) not in self.measures:
            self.measures.append((agg, field))

    def _grouped(self, filters: Mapping[str, Any] | None) -> DataFrame:
        """``set, rows``, the keys ``g0, ...`` and the measures ``m0, ...``."""
        tests = [_named(f) == F.lit(v).cast(self.df.schema[f].dataType) for f, v in (filters or {}).items() if v not in (None, "", ALL)]
        keep = F.coalesce(reduce(and_, tests), F.lit(False)) if tests else F.lit(True)
        keys = [_named(c).alias(f"g{i}") for i, c in enumerate(self.keys)]
        inputs = [F.when(keep, _named(field)).alias(f"f{i}") for i, (_, field) in enumerate(self.measures)]
        rows = self.df.select(*keys, *inputs, keep.alias("keep"))
        values = [agg_expr(rows, agg, f"f{i}", self.approximate).alias(f"m{i}") for i, (agg, _) in enumerate(self.measures)]
        if not self.keys:
            return rows.agg(F.count_if("keep").alias("rows"), *values).select(F.lit(0).cast("long").alias("set"), "*")
        names = [f"g{i}" for i in range(len(self.keys))]
        sets = [[f"g{i}" for i, c in enumerate(self.keys) if c in own] for own in self.sets]
        grouped = rows.groupingSets(sets, *names).agg(F.grouping_id().cast("long").alias("set"), F.count_if("keep").alias("rows"), *values)
        return grouped.select("set", "rows", *names, *[f"m{i}" for i in range(len(values))])

    def _is(self, columns: Sequence[str]) -> Column:
        """Rows of the set: a bit is set for each column that it does not group by, the first one highest."""
        last = len(self.keys) - 1
        return F.col("set") == sum(1 << (last - i) for i, c in enumerate(self.keys) if c not in columns)

    def _key(self, column: str) -> Column:
        return F.col(f"g{self.keys.index(column)}")

    def options(self, field: str) -> DataFrame:
        return self.table.where(self._is([field]) & self._key(field).isNotNull()).select(self._key(field).alias(field)).orderBy(_named(field))

    def kpis(self) -> DataFrame:
        values = []
        for i, k in enumerate(self.spec["kpis"]):
            if self._counted(k["agg"]):
                value = F.count_if(self._is([k["field"]]) & self._key(k["field"]).isNotNull() & (F.col("rows") > 0)).cast("double")
            else:
                value = F.coalesce(F.max(F.when(self._is([]), F.col(f"m{self.measures.index((k['agg'], k['field']))}"))), F.lit(0.0))
            values.append(value.alias(f"k{i}"))
        return self.table.agg(*values)

    def widget(self, widget: Mapping[str, Any]) -> DataFrame:
        by, agg, y = self._by(widget), widget["agg"], widget["y"]
        x, s = self._key(by[0]).alias("x"), self._key(by[1]).alias("s") if len(by) > 1 else F.lit("all").alias("s")
        names = ["x"] if widget["type"] != "line" else ["x", "s"]
        if self._counted(agg):
            found = self.table.where(self._is([*by, y]) & (F.col("rows") > 0)).select(x, s, self._key(y).alias("y"))
            found = found.groupBy(*names).agg(F.count("y").cast("double").alias("y"))
        else:
            measure = F.col(f"m{self.measures.index((agg, y))}").alias("y")
            found = self.table.where(self._is(by) & (F.col("rows") > 0)).select(x, s, measure).select(*names, "y")
        if widget["type"] == "line":
            return _drawn(found, True, widget.get("series"))
        return _ranked(found, widget.get("limit"))


def dashboard(
    df: DataFrame, spec: Mapping[str, Any], filters: Mapping[str, Any] | None = None, approximate: bool = False
) -> dict[str, Any]:
    """All frames of a dashboard spec: ``filters``, ``kpis`` and ``widgets``.

    The rows are read once: the groups of all panels are written to the scratch folder, and the
    frames read these. Lines are zero-filled; ``approximate`` goes to every distinct count.
    """
    panels = Panels(df, spec, filters, approximate)
    if panels.table is not None:
        path = scratch(df.sparkSession, "panels")
        schema = panels.table.schema
        panels.table.write.parquet(path)
        panels.table = df.sparkSession.read.schema(schema).parquet(path)
    return {
        "filters": {f["field"]: panels.options(f["field"]) for f in spec.get("filters", [])},
        "kpis": panels.kpis() if spec.get("kpis") else None,
        "widgets": [panels.widget(w) for w in spec.get("widgets", [])],
    }
