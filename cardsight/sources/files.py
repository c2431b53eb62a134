"""File sources and sinks.

Sinks write under the session's shared checkpoint folder (never a
machine-local temp folder) and return the path; readers take a declared
schema so no job is spent on inference and types are stable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cardsight.session import scratch_path


def merge_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Many same-shaped files read as one table in one scan.

    Columns are aligned by name and a column absent from a file reads as NULL:
    with a declared schema the reader fills them; without one, Parquet merges
    the file schemas (``mergeSchema``) and JSON unions its fields. CSV needs a
    declared schema (its columns are positional).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "parquet":
        return reader.option("mergeSchema", schema is None).parquet(*paths)
    if fmt == "json":
        return reader.json(paths)
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV merge needs a declared schema")
        return reader.option("header", True).csv(paths)
    raise ValueError(f"unsupported format {fmt!r}")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema (no type inference pass)."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_parquet(
    df: DataFrame,
    spark: SparkSession,
    label: str,
    compression: str = "gzip",
    path: str | None = None,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Parquet sink (gzip by default); returns the folder written."""
    path = path or scratch_path(spark, label)
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, spark: SparkSession, label: str, path: str | None = None) -> str:
    """Header CSV sink without any row-index column; returns the folder written."""
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
