"""Delimited ranking files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RANKING_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("season", T.IntegerType()),
        T.StructField("pos", T.StringType()),
        T.StructField("rank", T.StringType()),
    ]
)


def read_rankings(
    spark: SparkSession, path: str, schema: T.StructType = RANKING_SCHEMA
) -> DataFrame:
    """Semicolon-separated ISO-8859-1 file with a header line.

    The columns are matched to `schema` by position; the rank stays text, the
    caller coerces it (`functions.coerce_number`).
    """
    return spark.read.csv(path, sep=";", encoding="ISO-8859-1", header=True, schema=schema)
