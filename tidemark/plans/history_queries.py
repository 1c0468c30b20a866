"""Snapshots over time: storing, backfilling, looking up and joining point in time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import asof, backfill, state
from tidemark.operators.retrieval import parity_check as parity
from tidemark.plans import fixtures as fx
from tidemark.plans import sql
from tidemark.session import new_path, stage
from tidemark.sources import mapping, tables
from tidemark.schemas import FEATURE_HISTORY

SINCE, UNTIL = datetime(1997, 1, 1), datetime(1999, 1, 1)
AS_OF = datetime(1998, 7, 15)
SPINE = dict(days=90, interval_hours=6)
EXPECTED = 5


def _stored(spark, folder, features, **bounds):
    path = new_path(spark, "history")
    tables.append_history(path, features, fx.SNAPSHOT, **bounds)
    return path


def history_scan(spark, folder):
    path = _stored(spark, folder, fx.quarters(spark, folder))
    found = tables.scan_history(tables.read(spark, path, FEATURE_HISTORY), since=SINCE, until=UNTIL)
    return found.select("entity_id", "event_time", "txn_count_90d", "total_spend_90d", "snapshot_id")


def history_append_idempotent(spark, folder):
    """The second append brings other values for the same keys and must change nothing."""
    first = fx.snapshot(spark, folder)
    path = _stored(spark, folder, first)
    again = first.withColumn("txn_count_7d", F.col("txn_count_7d") + 1)
    tables.append_history(path, again, fx.SNAPSHOT, fx.SNAPSHOT, fx.SNAPSHOT)
    return tables.read(spark, path, FEATURE_HISTORY).select(
        "entity_id", "entity_type", "feature_version", "event_time", *fx.FEATURES
    )


def snapshot_features(spark, folder):
    path = _stored(spark, folder, fx.snapshot(spark, folder))
    return tables.read(spark, path, FEATURE_HISTORY).select("entity_id", "event_time", *fx.FEATURES, "computed_at")


def snapshot_rowcount(spark, folder):
    path = _stored(spark, folder, fx.quarters(spark, folder))
    return tables.snapshot_row_count(tables.read(spark, path, FEATURE_HISTORY), fx.SNAPSHOT)


def table_counts(spark, folder):
    users, transactions, tickets = mapping.raw(spark, folder)
    return tables.load_raw(
        new_path(spark, "raw"), raw_users=users, raw_transactions=transactions, raw_support_tickets=tickets
    )


def _spine(spark, folder):
    last = mapping.transactions(spark, folder).agg(F.max("event_time").alias("last"))
    return backfill.spine_from(last, "last", **SPINE)


def _order_days(spark, folder):
    """Days with orders stand for snapshots that are stored."""
    return mapping.transactions(spark, folder).select(
        F.col("user_id").alias("entity_id"), F.lit("v1").alias("feature_version"), "event_time"
    )


def snapshot_spine(spark, folder):
    return _spine(spark, folder)


def backfill_pending(spark, folder):
    return backfill.pending_snapshots(_spine(spark, folder), _order_days(spark, folder))


def backfill_plan(spark, folder):
    return backfill.backfill_plan(_spine(spark, folder), _order_days(spark, folder), expected_rows=EXPECTED)


def backfill_history(spark, folder):
    return fx.history(spark, folder, fx.DAILY)


def backfill_next_day(spark, folder):
    """The last day of the daily grid from the stored state of the day before."""
    users, transactions, tickets = mapping.raw(spark, folder)
    now = fx.DAILY["now"]
    before = now - timedelta(hours=fx.DAILY["interval_hours"])
    stored = stage(state.state_at(transactions, tickets, before), "state")
    return state.features_of(state.advance(stored, transactions, tickets, before, now), users, now)


def latest_asof(spark, folder):
    rows = asof.latest_asof(fx.quarters(spark, folder), AS_OF)
    return rows.select("entity_id", "event_time", *fx.FEATURES)


def latest_for_ids(spark, folder):
    return asof.latest_for_ids(fx.quarters(spark, folder), fx.part_ids(spark, folder), AS_OF)


def pit_join(spark, folder):
    return asof.pit_join(fx.ticket_labels(spark, folder), fx.stored_history(spark, folder, fx.QUARTERS))


def pit_join_versioned(spark, folder):
    """A second version with later times must not be seen."""
    v1 = fx.stored_history(spark, folder, fx.QUARTERS)
    v2 = v1.withColumns({
        "feature_version": F.lit("v2"), "event_time": F.col("event_time") + F.expr("INTERVAL '10' DAY")
    })
    return asof.pit_join(fx.ticket_labels(spark, folder), v1.unionByName(v2), "v1")


def pit_join_orders(spark, folder):
    """Each line with the customer's largest order of the latest order day up to its ship date."""
    orders, lines = mapping.table(spark, folder, "orders"), mapping.table(spark, folder, "lineitem")
    history = (
        orders.groupBy(F.col("o_custkey").alias("entity_id"), F.col("o_orderdate").alias("event_time"))
        .agg(F.max("o_totalprice").alias("order_price"))
        .withColumn("feature_version", F.lit("v1"))
    )
    labels = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("entity_id"), F.col("l_shipdate").alias("label_time"), "l_orderkey", "l_linenumber"
    )
    return asof.pit_join(labels, history, columns=["order_price"])


def parity_check(spark, folder):
    stored = fx.quarters(spark, folder).where(F.col("event_time") == F.lit(str(fx.SNAPSHOT)).cast("timestamp_ntz"))
    return parity(stored, fx.snapshot(spark, folder))


QUERIES = {
    "history_scan": history_scan,
    "history_append_idempotent": history_append_idempotent,
    "snapshot_features": snapshot_features,
    "snapshot_rowcount": snapshot_rowcount,
    "table_counts": table_counts,
    "snapshot_spine": snapshot_spine,
    "backfill_pending": backfill_pending,
    "backfill_plan": backfill_plan,
    "backfill_history": backfill_history,
    "backfill_next_day": backfill_next_day,
    "latest_asof": latest_asof,
    "latest_for_ids": latest_for_ids,
    "pit_join": pit_join,
    "pit_join_versioned": pit_join_versioned,
    "pit_join_orders": pit_join_orders,
    "parity_check": parity_check,
}

_SPINE_SQL = f"""
spine AS (
  SELECT e - to_hours(CAST({SPINE['interval_hours']} * i AS INTEGER)) AS event_time
  FROM (SELECT date_trunc('hour', max(event_time)) AS e FROM raw_transactions),
       generate_series(0, {SPINE['days'] * 24 // SPINE['interval_hours']}) AS g(i)
)"""
_LABELS_SQL = """
labels_in AS (SELECT user_id AS entity_id, event_time AS label_time, ticket_id FROM raw_support_tickets)"""
_PIT_SQL = f"""
SELECT l.entity_id, l.label_time, l.ticket_id, h.event_time AS feature_time, {', '.join('h.' + c for c in fx.FEATURES)}
FROM labels_in l ASOF LEFT JOIN h ON l.entity_id = h.entity_id AND l.label_time >= h.event_time"""
_LATEST_SQL = f"""
latest AS (
  SELECT * FROM h WHERE event_time <= {sql.ts(AS_OF)}
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY event_time DESC) = 1
)"""

ORACLES = {
    "history_scan": sql.with_(fx.QUARTERS_SQL) + f"""
SELECT entity_id, event_time, txn_count_90d, total_spend_90d, strftime(event_time, '%Y%m%d%H%M%S') AS snapshot_id
FROM h WHERE event_time >= {sql.ts(SINCE)} AND event_time <= {sql.ts(UNTIL)}""",
    "history_append_idempotent": sql.with_(fx.SNAPSHOT_SQL) + "SELECT * FROM fv",
    "snapshot_features": sql.with_(fx.SNAPSHOT_SQL)
    + f"SELECT entity_id, event_time, {fx.F13}, event_time AS computed_at FROM fv",
    "snapshot_rowcount": sql.with_(fx.QUARTERS_SQL)
    + f"SELECT count(*) AS n_rows FROM h WHERE event_time = {sql.ts(fx.SNAPSHOT)}",
    "table_counts": sql.with_(sql.RAW) + """
SELECT 'raw_users' AS table_name, count(*) AS n_rows FROM raw_users
UNION ALL SELECT 'raw_transactions', count(*) FROM raw_transactions
UNION ALL SELECT 'raw_support_tickets', count(*) FROM raw_support_tickets""",
    "snapshot_spine": sql.with_(sql.RAW, _SPINE_SQL) + "SELECT event_time FROM spine",
    "backfill_pending": sql.with_(sql.RAW, _SPINE_SQL)
    + "SELECT event_time FROM spine EXCEPT SELECT event_time FROM raw_transactions",
    "backfill_plan": sql.with_(sql.RAW, _SPINE_SQL) + f"""
SELECT s.event_time, coalesce(n, 0) AS stored_rows,
       CASE WHEN coalesce(n, 0) >= {EXPECTED} THEN 'stored' WHEN coalesce(n, 0) > 0 THEN 'partial' ELSE 'pending' END AS state
FROM spine s LEFT JOIN (SELECT event_time, count(*) AS n FROM raw_transactions GROUP BY event_time) t
  ON t.event_time = s.event_time""",
    "backfill_history": sql.with_(sql.RAW, sql.history("d", **fx.DAILY)) + "SELECT * FROM d",
    "backfill_next_day": sql.with_(sql.RAW, sql.history("d", **fx.DAILY))
    + f"SELECT * FROM d WHERE event_time = {sql.ts(fx.DAILY['now'])}",
    "latest_asof": sql.with_(fx.QUARTERS_SQL, _LATEST_SQL) + f"SELECT entity_id, event_time, {fx.F13} FROM latest",
    "latest_for_ids": sql.with_(fx.QUARTERS_SQL, _LATEST_SQL)
    + f"SELECT entity_id, {fx.F13} FROM latest WHERE entity_id IN (SELECT p_partkey FROM part)",
    "pit_join": sql.with_(fx.QUARTERS_SQL, _LABELS_SQL) + _PIT_SQL,
    "pit_join_versioned": sql.with_(fx.QUARTERS_SQL, _LABELS_SQL) + _PIT_SQL,
    "pit_join_orders": """
WITH h AS (
  SELECT o_custkey AS entity_id, o_orderdate AS event_time, max(o_totalprice) AS order_price
  FROM orders GROUP BY o_custkey, o_orderdate
),
l AS (
  SELECT o_custkey AS entity_id, l_shipdate AS label_time, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT l.entity_id, l.label_time, l.l_orderkey, l.l_linenumber, h.event_time AS feature_time, h.order_price
FROM l ASOF LEFT JOIN h ON l.entity_id = h.entity_id AND l.label_time >= h.event_time""",
    "parity_check": sql.with_(fx.QUARTERS_SQL, sql.snapshot("fv", fx.SNAPSHOT))
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, count(*) AS n_entities, "
        f"count(*) FILTER (h0.{c} IS DISTINCT FROM fv.{c}) AS n_different "
        f"FROM (SELECT * FROM h WHERE event_time = {sql.ts(fx.SNAPSHOT)}) h0 FULL JOIN fv ON fv.entity_id = h0.entity_id"
        for c in fx.FEATURES
    ),
}
