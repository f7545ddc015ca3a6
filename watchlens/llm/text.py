"""Words and text batches, shared by the corpus operators.

A word is a run of characters other than the six ASCII blanks. On UTF-8 bytes that is
exactly what `bytes.split()` cuts, and `bytes.lower()` folds exactly A-Z, so tasks work
on bytes and decode only where code points count.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
BLANKS = r"[\x20\x09-\x0D]"

#: Most rows, and most bytes, that one Arrow batch carries into a Python task.
BATCH_ROWS, BATCH_BYTES = 2000, 32 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that long texts do not fill a task's memory.

    Also lets tasks import this package where it lies beside the driver's, as on a local master.
    """
    known = spark.sparkContext.environment
    paths = [path for path in known.get("PYTHONPATH", "").split(os.pathsep) if path]
    if PACKAGE_ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo `modulus`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column's UTF-8 bytes; empty for null."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def pieces_of(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
