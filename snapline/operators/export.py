"""CSV export in the spreadsheet dialect of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.functions.texts import export_text
from snapline.sources.files import write_text

# Fixed values.
SEPARATOR = ";"
BYTE_ORDER_MARK = "\ufeff"
NEEDS_QUOTES = '[",\n;]'
CSV_NAME = "value"


def _cell(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(NEEDS_QUOTES), quoted).otherwise(text)


def _header(df: DataFrame, sep: str) -> str:
    cells = []
    for name in df.columns:
        special = any(c in name for c in '",\n;')
        cells.append('"' + name.replace('"', '""') + '"' if special else name)
    return sep.join(cells)


def csv_lines(df: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """One text line per row: NULL is empty, a value with a quote, comma, semicolon or
    newline is quoted, quotes are doubled, numbers have no needless fraction or exponent."""
    cells = [_cell(export_text(df, name)) for name in df.columns]
    return df.select(F.concat_ws(sep, *cells).alias(CSV_NAME))


def write_csv(df: DataFrame, path: str, bom: bool = True, sep: str = SEPARATOR) -> None:
    """Text files that each open as a spreadsheet: byte order mark and header, then rows.

    The low 33 bits of ``monotonically_increasing_id`` number the rows of a task, and a
    task writes one file, so the header goes before row 0 of each without leaving the JVM.
    """
    header = (BYTE_ORDER_MARK if bom else "") + _header(df, sep)
    lines = csv_lines(df, sep)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    value = F.when(first, F.concat(F.lit(header + "\n"), F.col(CSV_NAME))).otherwise(F.col(CSV_NAME))
    lines.select(value.alias(CSV_NAME)).write.mode("overwrite").option("maxRecordsPerFile", 0).text(path)
    if df.sparkSession.read.text(path).isEmpty():
        write_text(df.sparkSession, f"{path}/part-header.csv", header + "\n")
