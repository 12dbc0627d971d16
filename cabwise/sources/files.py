"""File sources and sinks: headerless CSV (inferred or declared schema), text
lines, Parquet, and bucketed tables for shuffle-free joins.

Writers take an explicit ``mode`` (default ``errorifexists``: a rerun never
silently replaces data). Readers never infer when a schema is given, and
malformed fields become nulls (``PERMISSIVE``) that the validity filters drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# --- CSV -------------------------------------------------------------------
def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Positional columns ``_c0..``, types inferred by an extra pass over the
    data (the cost the reference pays on its SQL-on-CSV path).

    Columns inferred as timestamps are read again as text and parsed to
    TIMESTAMP_NTZ: a wall clock inside a daylight-saving gap of the session
    zone keeps its hour."""
    inferred = spark.read.csv(path, header=False, inferSchema=True).schema
    times = [f.name for f in inferred if f.dataType.typeName() in ("timestamp", "timestamp_ntz")]
    declared = StructType([StructField(f.name, StringType() if f.name in times else f.dataType) for f in inferred])
    rows = spark.read.schema(declared).csv(path, header=False)
    return rows.select(*[F.col(c).try_cast("timestamp_ntz").alias(c) if c in times else F.col(c) for c in rows.columns])


def read_csv_schema(spark: SparkSession, path: str, schema: StructType,
                    header: bool = False) -> DataFrame:
    """Declared schema, no inference pass; unparsable fields → null."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path, header=header)


def name_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """``_c0.._cN`` → the given names, in order."""
    return df.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)])


# --- text lines ----------------------------------------------------------------
def write_text(df: DataFrame, path: str, mode: str = "errorifexists", col: str = "value") -> str:
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per physical line, column ``value``."""
    return spark.read.text(path)


def split_fields(lines: DataFrame, sep: str = ",", col: str = "value") -> DataFrame:
    """Adds ``fields``: the line split on ``sep`` with trailing empty fields
    kept (the same list Python's ``str.split(sep)`` returns)."""
    return lines.withColumn("fields", F.split(F.col(col), _regex_literal(sep), -1))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)


# --- Parquet ---------------------------------------------------------------------
def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


# --- bucketed tables -------------------------------------------------------------
def write_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   mode: str = "errorifexists", path: str | None = None) -> str:
    """Save ``df`` as a table bucketed and sorted on ``key``.

    Two tables bucketed on the join key with the same bucket count join
    without any exchange: the hash partitioning is read from the catalog.
    The rows are first hash-partitioned into ``buckets`` partitions on the
    key (the same hash Spark uses for buckets), so each task writes exactly
    one bucket file — without it every task would write a file per bucket.
    """
    placed = df.repartition(buckets, key)
    writer = placed.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table
