"""Moments and derived tables that the registered queries share."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import distribution, online, training
from tidemark.operators.backfill import backfill_history, backfill_split
from tidemark.operators.features import feature_vector
from tidemark.plans import sql
from tidemark.schemas import FEATURES
from tidemark.session import stage
from tidemark.sources import mapping

SNAPSHOT = datetime(1998, 6, 1)
# Every 90 days from before the first order to after the last shipment, through SNAPSHOT.
QUARTERS = dict(now=datetime(2001, 11, 12), days=2520, interval_hours=2160)
DAILY = dict(now=datetime(1998, 8, 30), days=90, interval_hours=24)
TRAINED_AT = datetime(1998, 3, 3)
TRAINING_WEEK = dict(now=TRAINED_AT, days=7, interval_hours=24)
SERVING_DAY = dict(now=SNAPSHOT, days=1, interval_hours=24)
LABEL_WINDOW_DAYS = 90
MIN_BEFORE = 1


def snapshot(spark: SparkSession, folder: str, at: datetime = SNAPSHOT) -> DataFrame:
    return feature_vector(*mapping.raw(spark, folder), at)


def history(spark: SparkSession, folder: str, grid: dict) -> DataFrame:
    return backfill_history(*mapping.raw(spark, folder), **grid)


def quarters(spark: SparkSession, folder: str) -> DataFrame:
    return history(spark, folder, QUARTERS)


def quarters_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The rows of `quarters` up to SNAPSHOT, and those after it."""
    return backfill_split(*mapping.raw(spark, folder), SNAPSHOT, **QUARTERS)


def one_row_per_user(spark: SparkSession, folder: str) -> bool:
    """Whether no user comes twice, so that no key of a history does."""
    per_user = mapping.table(spark, folder, "customer").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_user.where("n > 1").isEmpty()


def stored_history(spark: SparkSession, folder: str, grid: dict) -> DataFrame:
    """History as a store holds it, written once: for queries that read it more than once."""
    return stage(history(spark, folder, grid), "history")


def labelled_history(spark: SparkSession, folder: str, labels: DataFrame, grid: dict) -> DataFrame:
    """History of the users that `labels` name: rows of nobody else can meet a label.

    Running sums are made for these users only, as a condition on the finished rows does not reach the facts
    below them. `labels` is read several times and should be stored.
    """
    ids = labels.selectExpr("entity_id AS user_id").distinct()
    return backfill_history(*(rows.join(ids, "user_id", "left_semi") for rows in mapping.raw(spark, folder)), **grid)


def ticket_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Each support ticket asks for its user's features at the time it was opened."""
    return mapping.tickets(spark, folder).select(
        F.col("user_id").alias("entity_id"), F.col("event_time").alias("label_time"), "ticket_id"
    )


def churn(spark: SparkSession, folder: str) -> DataFrame:
    return training.churn_labels(
        mapping.users(spark, folder), mapping.transactions(spark, folder), SNAPSHOT, LABEL_WINDOW_DAYS, MIN_BEFORE
    )


def part_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Requested ids: all part keys, of which the larger ones belong to no user."""
    return mapping.table(spark, folder, "part").select(F.col("p_partkey").alias("entity_id"))


EARLIER = SNAPSHOT - timedelta(days=90)
STALE_WRITE = SNAPSHOT - timedelta(hours=60)


def online_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All users written long ago, and the recently active ones written at SNAPSHOT."""
    old = online.as_online(snapshot(spark, folder, EARLIER), STALE_WRITE)
    active = snapshot(spark, folder).where(F.col("txn_count_90d") > 0)
    return old, online.as_online(active, SNAPSHOT)


def online_table(spark: SparkSession, folder: str) -> DataFrame:
    return online.upsert(*online_batches(spark, folder))


def drift_windows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        distribution.window_rows(stored_history(spark, folder, TRAINING_WEEK), TRAINED_AT, 7),
        distribution.window_rows(stored_history(spark, folder, SERVING_DAY), SNAPSHOT, 1),
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Digits beyond the sixth depend on the order of summation."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


F13 = ", ".join(FEATURES)
SNAPSHOT_SQL = sql.RAW + "," + sql.snapshot("fv", SNAPSHOT)
QUARTERS_SQL = sql.RAW + "," + sql.history("h", **QUARTERS)
CHURN_SQL = f"""
churn AS (
  SELECT entity_id, {sql.ts(SNAPSHOT)} AS label_time, txns_before, txns_after,
         CASE WHEN txns_after = 0 AND txns_before >= {MIN_BEFORE} THEN 1 ELSE 0 END AS churned
  FROM (
    SELECT u.user_id AS entity_id,
           count(*) FILTER (t.status = 'success' AND t.event_time >= {sql.ts(SNAPSHOT)} - INTERVAL {LABEL_WINDOW_DAYS} DAY
                            AND t.event_time < {sql.ts(SNAPSHOT)}) AS txns_before,
           count(*) FILTER (t.status = 'success' AND t.event_time >= {sql.ts(SNAPSHOT)}
                            AND t.event_time < {sql.ts(SNAPSHOT)} + INTERVAL {LABEL_WINDOW_DAYS} DAY) AS txns_after
    FROM raw_users u LEFT JOIN raw_transactions t ON t.user_id = u.user_id
    GROUP BY u.user_id
  ) WHERE txns_before > 0
)"""
ONLINE_SQL = (
    sql.RAW + "," + sql.snapshot("old", EARLIER) + "," + sql.snapshot("fv", SNAPSHOT) + f""",
batches AS (
  SELECT entity_type, entity_id, feature_version, {F13}, event_time, {sql.ts(STALE_WRITE)} AS written_at FROM old
  UNION ALL
  SELECT entity_type, entity_id, feature_version, {F13}, event_time, {sql.ts(SNAPSHOT)} AS written_at
  FROM fv WHERE txn_count_90d > 0
),
online AS (
  SELECT * FROM batches
  QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id, feature_version
                             ORDER BY event_time DESC, written_at DESC) = 1
)"""
)
