"""Keys and numbers as they arrive from different stores, as one BIGINT domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# A failing cast costs an exception per row, dirty columns have millions of them: the
# tests below let only castable values through.
_WHOLE = r"^\s*[-+]?\d{1,18}\s*$"
_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def _in_range(number: Column) -> Column:
    """A DOUBLE without fraction as BIGINT; NaN and overflow -> NULL."""
    return F.when((number >= -(2.0**63)) & (number < 2.0**63), number.cast("bigint"))


def to_key(column: Column | str) -> Column:
    """Floating-point id -> BIGINT, rounding half to even; NaN and overflow -> NULL.

    Spark's own cast truncates, so 1.9999999 would become another customer's id.
    """
    return _in_range(F.rint(_col(column).cast("double")))


def _from_text(text: Column, fractional: Column) -> Column:
    whole = text.rlike(_WHOLE)
    return F.when(whole, text.cast("bigint")).when(text.rlike(_NUMBER), fractional)


def safe_bigint(column: Column | str) -> Column:
    """Text -> BIGINT, rounding half away from zero; anything unreadable -> NULL.

    No step goes through a floating-point type, so ids above 2^53 stay exact.
    """
    text = _col(column).cast("string")
    return _from_text(text, F.round(text.try_cast("decimal(38,18)")).try_cast("bigint"))


def truncated_bigint(column: Column | str) -> Column:
    """Text -> BIGINT, dropping the fraction; anything unreadable -> NULL."""
    text = _col(column).cast("string")
    return _from_text(text, text.try_cast("decimal(38,18)").try_cast("bigint"))


def key_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as a BIGINT key, by its declared type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return to_key(name)
    return safe_bigint(name)


# Fixed value: what counts as a number written as text.
NUMBER_TEXT = r"^-?\d+(\.\d+)?$"


def is_number_text(column: Column | str) -> Column:
    return _col(column).rlike(NUMBER_TEXT)
