"""Pieces of the SQL that states the expected rows of the registered queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from tidemark.schemas import FEATURES

RAW = """
raw_users AS (
  SELECT c.c_custkey AS user_id, CAST(o.first_order AS DATE) AS signup_date,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'free' WHEN 'BUILDING' THEN 'basic'
              WHEN 'FURNITURE' THEN 'pro' ELSE 'enterprise' END AS plan_type
  FROM customer c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) o
    ON o.o_custkey = c.c_custkey
),
raw_transactions AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount,
         o_orderpriority AS category,
         CASE WHEN o_orderstatus <> 'P' THEN 'success'
              WHEN o_orderpriority = '5-LOW' THEN 'refunded' ELSE 'failed' END AS status,
         o_orderdate AS event_time
  FROM orders
),
raw_support_tickets AS (
  SELECT l_orderkey * 10 + l_linenumber AS ticket_id, o_custkey AS user_id,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS resolved, l_shipdate AS event_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R'
)"""

REQUESTS = """
request_log AS (
  SELECT CASE WHEN event_type IN ('click', 'signup') THEN 'online_store'
              WHEN event_type = 'purchase' THEN 'batch' ELSE 'on_demand' END AS path,
         value AS latency_ms, event_type <> 'error' AS hit, ts
  FROM events
)"""


def ts(t: datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


def features_at(name: str, spine: str, version: str = "v1") -> str:
    """CTEs giving `name`: the features of every user at every time `s` of the relation `spine`."""
    month = "event_time >= s - INTERVAL 30 DAY"
    windows = "".join(
        f"""
         count(*) FILTER (status = 'success' AND event_time >= s - INTERVAL {n} DAY) AS c{n},
         sum(CAST(amount AS DECIMAL(28,8))) FILTER (status = 'success' AND event_time >= s - INTERVAL {n} DAY) AS m{n},"""
        for n in (7, 30, 90)
    )
    return f"""
{name}_txn AS (
  SELECT user_id, s,{windows}
         count(*) FILTER (status = 'failed' AND {month}) AS failed,
         count(*) FILTER ({month}) AS every,
         max(event_time) FILTER (status = 'success') AS last_ok
  FROM raw_transactions JOIN {spine} ON event_time < s GROUP BY user_id, s
),
{name}_tic AS (
  SELECT user_id, s, count(*) FILTER (resolved = 0) AS open, count(*) FILTER ({month}) AS recent
  FROM raw_support_tickets JOIN {spine} ON event_time < s GROUP BY user_id, s
),
{name} AS (
  SELECT u.user_id AS entity_id, 'user' AS entity_type, '{version}' AS feature_version, p.s AS event_time,
         CAST(coalesce(c7, 0) AS DOUBLE) AS txn_count_7d,
         CAST(coalesce(c30, 0) AS DOUBLE) AS txn_count_30d,
         CAST(coalesce(c90, 0) AS DOUBLE) AS txn_count_90d,
         CAST(coalesce(m7, 0) AS DOUBLE) AS total_spend_7d,
         CAST(coalesce(m30, 0) AS DOUBLE) AS total_spend_30d,
         CAST(coalesce(m90, 0) AS DOUBLE) AS total_spend_90d,
         coalesce(CASE WHEN c30 > 0 THEN CAST(m30 AS DOUBLE) / c30 END, 0) AS avg_txn_amount_30d,
         coalesce(failed, 0) / greatest(coalesce(every, 0), 1) AS failed_txn_rate_30d,
         CAST(coalesce(date_diff('day', last_ok, p.s), 9999) AS DOUBLE) AS days_since_last_txn,
         CAST(coalesce(open, 0) AS DOUBLE) AS open_tickets,
         CAST(coalesce(recent, 0) AS DOUBLE) AS ticket_rate_30d,
         CAST(date_diff('day', u.signup_date, CAST(p.s AS DATE)) AS DOUBLE) AS account_age_days,
         CAST(CASE u.plan_type WHEN 'free' THEN 0 WHEN 'basic' THEN 1 WHEN 'pro' THEN 2 ELSE 3 END AS DOUBLE)
           AS plan_encoded
  FROM raw_users u CROSS JOIN {spine} p
  LEFT JOIN {name}_txn t ON t.user_id = u.user_id AND t.s = p.s
  LEFT JOIN {name}_tic k ON k.user_id = u.user_id AND k.s = p.s
)"""


def grid(name: str, now: datetime, days: int, interval_hours: int) -> str:
    first = now - timedelta(hours=interval_hours * (days * 24 // interval_hours))
    return (
        f"{name} AS (SELECT unnest(generate_series({ts(first)}, {ts(now)}, INTERVAL {interval_hours} HOUR)) AS s)"
    )


def snapshot(name: str, t: datetime) -> str:
    """`name`: the features at one moment."""
    return f"{name}_spine AS (SELECT {ts(t)} AS s)," + features_at(name, f"{name}_spine")


def history(name: str, now: datetime, days: int, interval_hours: int) -> str:
    """`name`: the features on a grid."""
    return grid(f"{name}_spine", now, days, interval_hours) + "," + features_at(name, f"{name}_spine")


def cleaned(name: str, source: str, extra: str = "") -> str:
    """`name`: rows of `source` after cleaning, with the broken rules as text."""
    values = ", ".join(
        f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END AS {c}"
        for c in FEATURES
        if c != "failed_txn_rate_30d"
    )
    rate = "failed_txn_rate_30d"
    rules = ["CASE WHEN entity_id < 1 THEN 'entity_id:at_least_1' END"]
    for c in FEATURES:
        if c == "plan_encoded":
            rules.append(f"CASE WHEN {c} NOT IN (0, 1, 2, 3) THEN '{c}:known_code' END")
            continue
        rules.append(f"CASE WHEN {c} < 0 THEN '{c}:at_least_0' END")
        if c == rate:
            rules.append(f"CASE WHEN {c} > 1 THEN '{c}:at_most_1' END")
    return f"""
{name}_filled AS (
  SELECT entity_id, event_time, {values},
         CASE WHEN {rate} IS NULL OR isnan({rate}) THEN 0.0 WHEN {rate} > 1 AND {rate} <= 1.01 THEN 1.0
              WHEN {rate} < 0 THEN 0.0 ELSE {rate} END AS {rate}{extra}
  FROM {source}
),
{name} AS (SELECT *, concat_ws(',', {', '.join(rules)}) AS violations FROM {name}_filled)"""


def stats(name: str, source: str, where: str) -> str:
    """`name`: distribution statistics of each feature over rows of `source`."""
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, {c} AS value FROM {source} WHERE {where}" for c in FEATURES
    )
    return f"""
{name}_long AS ({parts}),
{name} AS (
  SELECT feature_name, avg(value) AS mean, stddev_pop(value) AS std,
         quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
         quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.95) AS p95,
         count(*) FILTER (value IS NULL OR isnan(value)) / greatest(count(*), 1) AS null_rate,
         count(*) AS sample_count
  FROM {name}_long GROUP BY feature_name HAVING count(value) > 0
)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n"
