"""Column profiles and the snapshot contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.functions.keys import is_number_text


def _text(field: T.StructField):
    """A text form that is distinct exactly when the values are."""
    column = F.col(f"`{field.name}`")
    return F.base64(column) if isinstance(field.dataType, T.BinaryType) else column.cast("string")


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: position, name, type, number of NULLs and of distinct values.

    The columns are unpivoted and counted per value first, so one exchange carries
    each distinct value of each column once per task, and a hot value is one row.
    ``approximate`` replaces that by sketches in a single pass without any exchange
    of values.
    """
    fields = df.schema.fields
    heads = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields, 1)]
    if approximate:
        stats = df.agg(*[
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("type"),
                F.count_if(F.col(f"`{name}`").isNull()).alias("nulls"),
                F.approx_count_distinct(_text(f)).alias("distinct_values"),
            ).alias(f"c{i}")
            for (i, name, kind), f in zip(heads, fields)
        ])
        return stats.select(F.inline(F.array(*stats.columns)))
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), _text(f).alias("value")) for (i, _, _), f in zip(heads, fields)
    ])
    per_value = df.select(F.inline(cells)).groupBy("position", "value").agg(F.count(F.lit(1)).alias("rows"))
    counts = per_value.groupBy("position").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0).cast("bigint")).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )
    names = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("type")) for _, n, k in heads])
    head = F.element_at(names, F.col("position"))
    return counts.select(
        "position", head["column_name"].alias("column_name"), head["type"].alias("type"), "nulls", "distinct_values"
    )


def numeric_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``column_name, is_numeric``: whether the first non-empty value, in ``order``, is a number.

    A typed number is one as soon as it has a value; text is judged by its first value,
    found by one aggregation with partial results, not by a sort.
    """
    key = F.struct(*order)
    tests = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            test = F.count(column) > 0
        elif isinstance(field.dataType, T.StringType):
            filled = column.isNotNull() & (column != "")
            first = F.min_by(F.when(filled, column), F.when(filled, key))
            test = F.coalesce(is_number_text(first), F.lit(False))
        else:
            test = F.lit(False)
        tests.append((field.name, test))
    flat = df.agg(*[test.alias(f"c{i}") for i, (_, test) in enumerate(tests)])
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("is_numeric"))
        for i, (name, _) in enumerate(tests)
    ]
    return flat.select(F.inline(F.array(*rows)))


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [name for name in expected if name not in df.columns]


def validate_report(
    df: DataFrame, expected_columns: Sequence[str], min_rows: int = 0, max_rows: int | None = None
) -> DataFrame:
    """One row per rule: ``rule, passed, value``; no upper bound unless one is given."""
    missing = missing_columns(df, expected_columns)
    n = F.col("n")
    rules = [
        ("expected_columns", F.lit(not missing), F.lit(",".join(missing))),
        ("min_rows", n >= min_rows, n.cast("string")),
    ]
    if max_rows is not None:
        rules.append(("max_rows", n <= max_rows, n.cast("string")))
    structs = [
        F.struct(F.lit(rule).alias("rule"), passed.alias("passed"), value.alias("value"))
        for rule, passed, value in rules
    ]
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*structs)))
