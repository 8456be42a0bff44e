"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key (as long) and the text, missing text as the empty text.

    Every operator starts from these two columns, so further columns of the
    input, whatever their names, can neither clash nor be carried along.
    """
    return df.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; a missing key counts as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % modulus


def py_remainder(key: int | None, modulus: int) -> int:
    """The same as `remainder`, inside a task."""
    return zlib.crc32(b"" if key is None else str(key).encode()) % modulus


ROWS = 1024  # rows worked on at once, so that a worker's memory does not grow with Spark's batches


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of at most ROWS."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            yield batch.slice(begin, ROWS)


DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def map_documents(docs: DataFrame, work) -> DataFrame:
    """The documents table after `work`, which takes an Arrow batch of it and returns one of the same columns."""
    rows = docs.select(*DOCUMENT)

    def each(batches):
        for batch in sliced(batches):
            yield work(batch)

    return rows.mapInArrow(each, rows.schema)
