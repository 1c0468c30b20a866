"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a task holds as Python objects at a time.
PART_ROWS = 1_024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for each Spark context.

    Spark serves the archive to executors itself; the driver's copy is only read while it does.
    """
    context = spark.sparkContext
    if "tidemark.zip" not in context._python_includes:
        top = Path(__file__).resolve().parents[2]
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/tidemark", "zip", top, "tidemark"))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def parts(batches: Iterable[pa.RecordBatch], rows: int = PART_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows: what a task makes of one is gone before the next."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def plain_lower(text: Column) -> Column:
    """Lower-case A-Z only; a null text becomes the empty one."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def joined(strings: Column) -> Column:
    return F.concat_ws(",", strings)
