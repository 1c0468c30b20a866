"""The online table: newest valid features per entity and version, with an age limit."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import moment
from tidemark.operators.asof import latest_asof
from tidemark.operators.run_log import run_status
from tidemark.operators.validation import validate
from tidemark.schemas import ENTITY_TYPE, FEATURES, ONLINE_KEY, ONLINE_TTL_HOURS, VERSION

ONLINE_COLUMNS = [*ONLINE_KEY, *FEATURES, "event_time", "written_at"]


def as_online(features: DataFrame, written_at: datetime) -> DataFrame:
    return features.withColumn("written_at", moment(written_at)).select(*ONLINE_COLUMNS)


def upsert(online: DataFrame, rows: DataFrame) -> DataFrame:
    """Old and new rows merged: per key the newest event time wins, then the newest write.

    Merging the same rows again changes nothing, so a repeated batch is harmless.
    """
    return newest(online.select(*ONLINE_COLUMNS).unionByName(rows.select(*ONLINE_COLUMNS)))


def newest(rows: DataFrame) -> DataFrame:
    """Per key the row with the newest event time, then the newest write, then the largest values."""
    order = Window.partitionBy(*ONLINE_KEY).orderBy(F.desc("event_time"), F.desc("written_at"), *[F.desc(c) for c in FEATURES])
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def delete(online: DataFrame, ids: DataFrame) -> DataFrame:
    """The table without the entities of a one-column frame of ids, in every version."""
    return online.join(ids.select(F.col(ids.columns[0]).alias("entity_id")), "entity_id", "left_anti")


def live(online: DataFrame, as_of: datetime, ttl_hours: int = ONLINE_TTL_HOURS) -> DataFrame:
    return online.where(F.col("written_at") > moment(as_of - timedelta(hours=ttl_hours)))


def lookup(
    online: DataFrame, ids: DataFrame, as_of: datetime, version: str = VERSION, ttl_hours: int = ONLINE_TTL_HOURS
) -> DataFrame:
    """One row per distinct requested id; ids that are unknown or expired have NULL features."""
    wanted = ids.select(F.col(ids.columns[0]).alias("entity_id")).distinct()
    # the table is cut to the ids asked for before it meets them, so a short list moves few of its rows
    online = online.join(wanted, "entity_id", "left_semi")
    current = live(online, as_of, ttl_hours).where(
        (F.col("feature_version") == version) & (F.col("entity_type") == ENTITY_TYPE)
    )
    return wanted.join(
        current.select("entity_id", *FEATURES, F.lit(True).alias("_found")), "entity_id", "left"
    ).select("entity_id", F.coalesce("_found", F.lit(False)).alias("hit"), *FEATURES)


def size(online: DataFrame, as_of: datetime, ttl_hours: int = ONLINE_TTL_HOURS) -> DataFrame:
    return live(online, as_of, ttl_hours).agg(F.count(F.lit(1)).alias("entities"))


def materialize_rows(history: DataFrame, as_of: datetime, version: str = VERSION) -> DataFrame:
    """The newest row per entity, cleaned, with its violations."""
    return validate(latest_asof(history, as_of, version))


def materialize_summary(entities: DataFrame, checked: DataFrame) -> DataFrame:
    """One row: how many of the entities were written, held back, or have no history yet."""
    total = entities.agg(F.count_distinct(entities.columns[0]).alias("total"))
    counts = checked.agg(
        F.count_if(F.size("violations") == 0).alias("processed"),
        F.count_if(F.size("violations") > 0).alias("validation_failures"),
        F.count(F.lit(1)).alias("with_history"),
    )
    failures = F.col("validation_failures")
    status = run_status(F.col("processed"), failures)
    # Both sides are single rows by construction.
    return total.withColumn("_one", F.lit(1)).join(counts.withColumn("_one", F.lit(1)), "_one").select(
        "total",
        "processed",
        F.lit(0).cast("bigint").alias("failed"),
        "validation_failures",
        (F.col("total") - F.col("with_history")).alias("skipped"),
        status.alias("status"),
    )
