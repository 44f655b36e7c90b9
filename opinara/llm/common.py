"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the query contracts: what a word is, in Java's, Python's and DuckDB's syntax alike.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def remainder(id_column: str | Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; null for a null id."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(column.cast("string")) % divisor


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Rows that a function of batches gets at once; their texts are Python objects meanwhile.
SLICE_ROWS = 2_000


def map_batches(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """mapInArrow with a function of one batch of at most SLICE_ROWS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield work(batch.slice(start, SLICE_ROWS))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
