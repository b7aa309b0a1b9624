"""Read-only SQL over a snapshot's views, saved views, quick charts."""

from __future__ import annotations

import re
import threading
from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.functions.keys import is_number_text

_QUERY = re.compile(r"\s*(select|with)\b", re.IGNORECASE)
_INSPECT = re.compile(r"\s*(describe|show)\b", re.IGNORECASE)
_FILES = "spark.sql.runSQLOnFiles"
# The option belongs to the session: one statement at a time may change it.
_changing = threading.Lock()


class NotReadOnly(ValueError):
    """The statement is not a plain read."""


def _check(spark: SparkSession, text: str) -> None:
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        if _QUERY.match(text):
            # Accepts queries only: "WITH ... INSERT" and a second statement fail here.
            parser.parseQuery(text)
            return
        if _INSPECT.match(text):
            if parser.parsePlan(text).getClass().getSimpleName().startswith(("Show", "Describe")):
                return
    except PySparkException as error:
        raise NotReadOnly(f"not a single read-only statement: {error}") from error
    raise NotReadOnly("only SELECT, WITH, DESCRIBE and SHOW are allowed")


def adhoc(spark: SparkSession, sql: str) -> DataFrame:
    """Run one read-only statement. Paths as tables and calls into the JVM are refused."""
    text = re.sub(r";+\s*$", "", sql.strip())
    _check(spark, text)
    with _changing:
        before = spark.conf.get(_FILES)
        spark.conf.set(_FILES, "false")
        try:
            df = spark.sql(text)
        finally:
            spark.conf.set(_FILES, before)
    if "expressions.CallMethodViaReflection" in df._jdf.queryExecution().analyzed().toJSON():
        raise NotReadOnly("calls into the JVM are not allowed")
    return df


def saved_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """A named query as a view that other queries can read.

    The view keeps the query's text, which is resolved anew at each use: after
    ``snapshot_views`` has opened a newer snapshot it answers from that one.
    """
    if not _QUERY.match(sql):
        raise NotReadOnly("only SELECT and WITH can be saved")
    adhoc(spark, sql)  # refuses what is not a plain read
    quoted = "`" + name.replace("`", "``") + "`"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quoted} AS {re.sub(r';+\s*$', '', sql.strip())}")
    return spark.table(quoted)


def quick_chart(df: DataFrame, numeric: Mapping[str, bool] | None = None) -> DataFrame | None:
    """``label, value``: the first column and the first numeric one after it, if any.

    ``numeric`` (see ``numeric_columns``) also tells which text columns hold numbers.
    """
    for field in df.schema.fields[1:]:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) and (numeric or {}).get(field.name):
            value = F.when(is_number_text(value), value).cast("double")
        elif not isinstance(field.dataType, T.NumericType):
            continue
        return df.select(F.col(f"`{df.columns[0]}`").alias("label"), value.alias("value"))
    return None
