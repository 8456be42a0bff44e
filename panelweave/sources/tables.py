"""Columnar table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float and double column.

    Missing numbers are skipped by min, max, mean and comparisons; Spark does
    that for NULL only (NaN is the largest number in Spark).
    """
    floats = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floats) if floats else df


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Parquet scan, optionally with a declared schema and a column list."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df


def read_periods(
    spark: SparkSession,
    path: str,
    column: str,
    lo,
    hi,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a period range, `lo <= column <= hi`.

    The range is a plain comparison on the stored column, so it prunes
    partition folders or Parquet row groups. NaN is turned into NULL after it.
    """
    df = read_table(spark, path, schema)
    kind = df.schema[column].dataType
    low, high = F.lit(lo).cast(kind), F.lit(hi).cast(kind)
    df = df.filter((F.col(column) >= low) & (F.col(column) <= high))
    if columns is not None:
        df = df.select(*columns)
    return nan_to_null(df)
