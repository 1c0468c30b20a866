"""Scans, filters and the features as of one snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import days_crossed_sql, in_window, moment_sql
from tidemark.operators import retrieval
from tidemark.operators.features import SUCCESS
from tidemark.plans import fixtures as fx
from tidemark.plans import sql
from tidemark.sources import mapping

ONE_ENTITY = 7


def scalar_dates(spark, folder):
    return mapping.transactions(spark, folder).selectExpr(
        "transaction_id",
        "to_date(event_time) AS event_date",
        "event_time - INTERVAL '7' DAY AS week_before",
        "CAST(date_trunc('hour', event_time) AS TIMESTAMP_NTZ) AS event_hour",
        f"{days_crossed_sql(moment_sql(fx.SNAPSHOT), 'event_time')} AS days_before_snapshot",
    )


def filter_window(spark, folder):
    kept = mapping.transactions(spark, folder).where(SUCCESS).where(in_window("event_time", fx.SNAPSHOT, 30))
    return kept.select("transaction_id", "user_id", "amount", "event_time")


def entity_ids(spark, folder):
    return mapping.users(spark, folder).select("user_id").distinct().orderBy("user_id")


def feature_vector(spark, folder):
    return fx.snapshot(spark, folder)


def _features(*names):
    return lambda spark, folder: fx.snapshot(spark, folder).select("entity_id", *names)


def on_demand_single(spark, folder):
    one = retrieval.on_demand_single(*mapping.raw(spark, folder), ONE_ENTITY, fx.SNAPSHOT)
    return one.select("entity_id", *fx.FEATURES, F.array_join("violations", ",").alias("violations"))


def on_demand_batch(spark, folder):
    rows = retrieval.on_demand_batch(*mapping.raw(spark, folder), fx.part_ids(spark, folder), fx.SNAPSHOT)
    return rows.select("entity_id", *fx.FEATURES, F.array_join("violations", ",").alias("violations"))


GROUPS = {
    "feat_txn_counts": ["txn_count_7d", "txn_count_30d", "txn_count_90d"],
    "feat_spend": ["total_spend_7d", "total_spend_30d", "total_spend_90d"],
    "feat_avg_amount": ["avg_txn_amount_30d"],
    "feat_failed_rate": ["failed_txn_rate_30d"],
    "feat_recency": ["days_since_last_txn"],
    "feat_tickets": ["open_tickets", "ticket_rate_30d"],
    "feat_account_age": ["account_age_days"],
    "feat_plan_encoded": ["plan_encoded"],
}

QUERIES = {
    "scan_users": mapping.users,
    "scan_transactions": mapping.transactions,
    "scan_tickets": mapping.tickets,
    "scalar_dates": scalar_dates,
    "filter_window": filter_window,
    "entity_ids": entity_ids,
    "feature_vector": feature_vector,
    **{key: _features(*names) for key, names in GROUPS.items()},
    "on_demand_single": on_demand_single,
    "on_demand_batch": on_demand_batch,
}

_T = sql.ts(fx.SNAPSHOT)
ORACLES = {
    "scan_users": sql.with_(sql.RAW) + "SELECT * FROM raw_users",
    "scan_transactions": sql.with_(sql.RAW) + "SELECT * FROM raw_transactions",
    "scan_tickets": sql.with_(sql.RAW) + "SELECT * FROM raw_support_tickets",
    "scalar_dates": sql.with_(sql.RAW) + f"""
SELECT transaction_id, CAST(event_time AS DATE) AS event_date,
       event_time - INTERVAL 7 DAY AS week_before, CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS event_hour,
       CAST(date_diff('day', event_time, {_T}) AS INTEGER) AS days_before_snapshot
FROM raw_transactions""",
    "filter_window": sql.with_(sql.RAW) + f"""
SELECT transaction_id, user_id, amount, event_time FROM raw_transactions
WHERE status = 'success' AND event_time >= {_T} - INTERVAL 30 DAY AND event_time < {_T}""",
    "entity_ids": sql.with_(sql.RAW) + "SELECT DISTINCT user_id FROM raw_users ORDER BY user_id",
    "feature_vector": sql.with_(fx.SNAPSHOT_SQL) + "SELECT * FROM fv",
    **{
        key: sql.with_(fx.SNAPSHOT_SQL) + f"SELECT entity_id, {', '.join(names)} FROM fv"
        for key, names in GROUPS.items()
    },
    "on_demand_single": sql.with_(fx.SNAPSHOT_SQL, sql.cleaned("checked", "fv"))
    + f"SELECT entity_id, {fx.F13}, violations FROM checked WHERE entity_id = {ONE_ENTITY}",
    "on_demand_batch": sql.with_(fx.SNAPSHOT_SQL, sql.cleaned("checked", "fv"))
    + f"""SELECT p.p_partkey AS entity_id, {fx.F13}, violations
FROM (SELECT DISTINCT p_partkey FROM part) p LEFT JOIN checked ON entity_id = p_partkey""",
}
