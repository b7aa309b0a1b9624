"""Values as the grid shows, searches and exports them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Between these a DOUBLE is written without an exponent.
FIXED_FROM, FIXED_BELOW = 1e-4, 1e16
# Between these Spark's own text has no exponent either.
PLAIN_FROM, PLAIN_BELOW = 1e-3, 1e7


# Whole numbers below are exact, so a BIGINT has the same digits.
EXACT_BELOW = float(1 << 53)


def _apart(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made(value)`` evaluated where it stands, with ``value`` bound once.

    In one generated expression Spark would evaluate what several branches share (the text, its
    digits and power) for every row, whichever branch it takes.
    """
    return F.get(F.transform(F.array(value), made), 0)


def _is_whole(number: Column, size: Column) -> Column:
    return (size < EXACT_BELOW) & (number == F.floor(number))


def double_text(column: Column) -> Column:
    """A DOUBLE as SQL text: ``100000000.0``, ``1e-05``, ``nan`` instead of ``1.0E8``, ``1.0E-5``, ``NaN``."""
    size = F.abs(column)
    return (
        F.when((size == 0) | ((size >= PLAIN_FROM) & (size < PLAIN_BELOW)), column.cast("string"))
        .when(_is_whole(column, size), F.concat(column.cast("bigint").cast("string"), F.lit(".0")))
        .when(column.isNotNull(), _apart(column, _odd_double_text))
    )


def _odd_double_text(number: Column) -> Column:
    text, size = number.cast("string"), F.abs(number)

    def fixed(decimal: str) -> Column:
        digits = F.regexp_replace(number.cast(decimal).cast("string"), "0+$", "")
        return F.regexp_replace(digits, r"\.$", ".0")

    power = F.split_part(text, F.lit("E"), F.lit(2)).cast("int")
    scientific = F.concat(
        F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", ""),
        F.when(power < 0, "e-").otherwise("e+"),
        F.when(F.abs(power) < 10, "0").otherwise(""),
        F.abs(power).cast("string"),
    )
    return (
        F.when(F.isnan(number), "nan")
        .when(size == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
        .when((size >= PLAIN_BELOW) & (size < FIXED_BELOW), fixed("decimal(38,18)"))
        .when((size >= FIXED_FROM) & (size < PLAIN_FROM), fixed("decimal(38,21)"))
        .otherwise(scientific)
    )


def _as_double(column: Column, kind: T.DataType) -> Column:
    """A FLOAT through its own shortest text, so that 0.1 does not become 0.10000000149."""
    return column.cast("string").cast("double") if isinstance(kind, T.FloatType) else column


def text_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as SQL text."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    return double_text(_as_double(column, kind)) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else column.cast("string")


def export_text(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a spreadsheet takes it: ``5`` and ``0.00001``, an exponent only from 1e21 and below 1e-6."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return column.cast("string")
    number = _as_double(column, kind)
    size = F.abs(number)
    return (
        F.when(_is_whole(number, size), number.cast("bigint").cast("string"))
        .when((size >= PLAIN_FROM) & (size < PLAIN_BELOW), number.cast("string"))
        .when(number.isNotNull(), _apart(number, _odd_export_text))
    )


def _odd_export_text(number: Column) -> Column:
    text, size = number.cast("string"), F.abs(number)
    digits = F.replace(F.replace(F.split_part(text, F.lit("E"), F.lit(1)), F.lit("-"), F.lit("")), F.lit("."), F.lit(""))
    digits = F.regexp_replace(digits, "0+$", "")
    power = F.when(text.contains("E"), F.split_part(text, F.lit("E"), F.lit(2)).cast("int")).otherwise(0)
    sign = F.when(number < 0, "-").otherwise("")

    def written(parts: Column) -> Column:
        sign, digits, power = (parts.getField(name) for name in ("sign", "digits", "power"))
        large = F.concat(sign, F.rpad(digits, power + 1, "0"))
        fraction = F.concat(sign, F.left(digits, power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits)))
        small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
        head = F.concat(sign, F.left(digits, F.lit(1)), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), F.length(digits)))).otherwise(""))
        scientific = F.concat(head, F.when(power < 0, "e").otherwise("e+"), power.cast("string"))
        return (
            F.when((size >= PLAIN_BELOW) & (size < 1e21), F.when(F.length(digits) > power + 1, fraction).otherwise(large))
            .when((size >= 1e-6) & (size < PLAIN_FROM), small)
            .otherwise(scientific)
        )

    return (
        F.when(F.isnan(number), "NaN")
        .when(size == float("inf"), F.when(number > 0, "Infinity").otherwise("-Infinity"))
        .otherwise(_apart(F.struct(sign.alias("sign"), digits.alias("digits"), power.alias("power")), written))
    )
