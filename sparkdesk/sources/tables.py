"""Opening Parquet tables, also those with column types Spark cannot infer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.cells import KINDS, column


def scan(
    spark: SparkSession,
    path: str | list[str],
    overrides: dict[str, str] | None = None,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """A Parquet table with the schema of its files.

    A file with a UUID, a time of day or nanoseconds has no schema Spark can
    infer: give ``schema`` with the stored type (``binary``, ``int``, ``bigint``) and name
    the meaning in ``overrides``, such as ``{"t": "time_millis", "u": "uuid"}``. The
    names are the keys of ``functions.cells.KINDS`` and ``decimal:<scale>``.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return mark(reader.parquet(*paths), overrides or {})


def mark(df: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """Note on columns what their stored values mean."""
    for name, kind in overrides.items():
        if name not in df.columns:
            raise ValueError(f"no such column: {name}")
        if kind not in KINDS and not kind.startswith("decimal:"):
            raise ValueError(f"unknown kind of cell: {kind}")
        df = df.withColumn(name, column(name).alias(name, metadata={"cell": kind}))
    return df


def with_position(df: DataFrame) -> DataFrame:
    """Adds ``pos``, a unique whole number per row that rises within each input task.

    Take it straight from a scan, before any shuffle, so that a retried task
    gives the same numbers.
    """
    return df.withColumn("pos", F.monotonically_increasing_id())
