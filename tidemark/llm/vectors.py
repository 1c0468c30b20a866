"""What the operators on vectors share: which vectors count, and passing them to tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def checked(table: DataFrame, labelled: bool = True) -> DataFrame:
    """(id, label, vector) of every row; the label is 0 throughout unless `labelled`.

    `vector`, as doubles, is NULL where it takes no part: null, empty or zero vectors, those that hold a
    null or non-finite component, and those of rows with a null id or label.
    """
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    label = F.col("label") if labelled else F.lit(0)
    takes_part = F.col("vec_id").isNotNull() & label.isNotNull() & F.coalesce(finite & some, F.lit(False))
    return table.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), F.when(takes_part, vector).alias("vector"))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(row, id, label, vector), written: different vectors, also of one id, each with a number of its own.

    Repeated rows are one vector; they merge inside the tasks, before the shuffle.
    """
    merged = rows.filter("vector IS NOT NULL").groupBy("id", "label", "vector").agg(F.count(F.lit(1)).alias("_n"))
    return stage(merged.select(F.monotonically_increasing_id().alias("row"), "id", "label", "vector"), "vectors")


def of_one_size(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows whose vector has the number of components that most vectors have (of equally many, the larger), and it.

    Vectors of another size can be near none of them and take no part. The number is 0 if there are no vectors.
    """
    sizes = rows.filter("vector IS NOT NULL").groupBy(F.size("vector").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = most["size"] if most else 0
    return rows.filter(F.size("vector") == size), size


def matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """The vectors of an Arrow column of lists, one per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dimension)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is divided out first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=0.0)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, also where the sum of the squares leaves the range of doubles."""
    with np.errstate(over="ignore", invalid="ignore"):
        away = vectors - query
        plain = np.sqrt((away * away).sum(axis=1))
        odd = np.flatnonzero(~np.isfinite(plain) | (plain < 1e-150))
        if len(odd):
            # halves, as a difference may be twice the largest double
            half = np.abs(vectors[odd] / 2 - query / 2)
            largest = half.max(axis=1, keepdims=True)
            scale = np.where(largest > 0, largest, 1.0)
            plain[odd] = 2 * (scale[:, 0] * np.sqrt(((half / scale) ** 2).sum(axis=1)))
    return plain
