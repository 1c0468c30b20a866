"""Choices that depend on how large an input is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A list of this many bigint ids takes about 30 MB as a broadcast table.
SMALL_IDS = 1_000_000


def is_small(ids: DataFrame, limit: int = SMALL_IDS) -> bool:
    """Whether the frame has at most `limit` rows; reads no more than that."""
    return ids.limit(limit + 1).count() <= limit


def restrict_to_ids(ids: DataFrame, key: str, *facts: DataFrame) -> list[DataFrame]:
    """Each of the fact tables with the rows whose key is among the ids, where that saves work.

    A short list is broadcast, which drops the other rows before any shuffle. With a long list
    the facts come back as they are: summing them per key and joining afterwards shuffles less
    than a semi-join of unsummed rows.
    """
    wanted = ids.select(F.col(ids.columns[0]).alias(key))
    if not is_small(wanted):
        return list(facts)
    return [rows.join(F.broadcast(wanted), key, "left_semi") for rows in facts]
