"""Number the rows of a table in an order, without sorting them in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.session import stage


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`rows` with their number in `order`, from 1.

    Rows are dealt by sampled ranges, numbered inside each range and written; the rows of the ranges
    before are added then. Only one number for each range is put in order by a single task. `order`
    should end in columns that tell rows apart, or many equal rows stay in one range.
    """
    ship(rows.sparkSession)

    def place(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(np.arange(at, at + batch.num_rows))],
                [*batch.schema.names, "_part", "_place"],
            )
            at += batch.num_rows

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(place, f"{kinds}, _part long, _place long"), "numbered"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(parts, "_part").withColumn(name, F.col("_before") + F.col("_place") + 1).select(*rows.columns, name)
