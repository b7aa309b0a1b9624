"""Source scans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class SourceSpec:
    """Where a source comes from and how it is shaped.

    ``location`` is a path, a table name or, for ``jdbc``, a query; ``options`` go to the
    reader; a ``schema`` saves it the look into the files. ``shape`` turns the raw scan into
    the model columns. ``keys`` restricts the source to the driver: ``(column, driver column)``.
    """

    name: str
    format: str
    location: str
    options: dict[str, str] = field(default_factory=dict)
    predicates: tuple[str, ...] = ()
    shape: Callable[[DataFrame], DataFrame] | None = None
    keys: tuple[str, str] | None = None
    schema: StructType | str | None = None
    one_task: bool = False

    @property
    def path(self) -> str | None:
        """Where its files are, if it is read from files."""
        return None if self.format in ("table", "jdbc") else self.location


def key_buckets(column: str, buckets: int) -> tuple[str, ...]:
    """Predicates that deal a relation's rows by an integer key into so many read tasks."""
    return (*(f"MOD({column}, {buckets}) IN ({i}, {-i})" if i else f"MOD({column}, {buckets}) = 0" for i in range(buckets)), f"{column} IS NULL")


def jdbc_options(spec: SourceSpec) -> dict[str, str]:
    """Reader options of a relational query.

    ``partitionColumn, lowerBound, upperBound, numPartitions`` in ``spec.options`` make the
    read parallel; they come together or not at all. Without them and without predicates one
    task would read everything, so that has to be asked for (``one_task``).
    """
    parallel = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
    given = parallel & set(spec.options)
    if given and given != parallel:
        raise ValueError(f"a parallel read also needs {sorted(parallel - given)}")
    if not given and not spec.predicates and not spec.one_task:
        raise ValueError(f"source '{spec.name}' would be read by one task: split it, or say one_task=True")
    if not spec.options.get("url"):
        raise ValueError(f"source '{spec.name}' has no url")
    query = spec.location.strip().rstrip(";")
    table = f"({query}) q" if query.lower().startswith(("select", "with")) else query
    return {"fetchsize": "10000", **spec.options, "dbtable": table}


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The source as a lazy DataFrame; nothing is fetched here."""
    if spec.format == "table":
        df = spark.table(spec.location)
    elif spec.format == "jdbc" and spec.predicates:
        options = jdbc_options(spec)
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        df = spark.read.jdbc(options["url"], options["dbtable"], predicates=list(spec.predicates), properties=rest)
    elif spec.format == "jdbc":
        df = spark.read.format("jdbc").options(**jdbc_options(spec)).load()
    else:
        reader = spark.read.format(spec.format).options(**spec.options)
        df = (reader.schema(spec.schema) if spec.schema else reader).load(spec.location)
    return spec.shape(df) if spec.shape else df
