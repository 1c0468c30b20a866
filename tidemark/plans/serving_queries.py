"""Validation, the online table, dual-path retrieval and the incremental refresh."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import online, retrieval, validation
from tidemark.plans import fixtures as fx
from tidemark.plans import sql
from tidemark.session import new_path
from tidemark.sources import mapping, online_log, tables
from tidemark.streaming.refresh import refresh_online

READ_AT = fx.SNAPSHOT + timedelta(hours=1)
END = fx.QUARTERS["now"]


def _as_text(df):
    return df.withColumn("violations", F.array_join("violations", ","))


def _dirty(spark, folder):
    """Features at the snapshot with gaps, NaN, noise above one and a broken rule put in."""
    changes = {
        "failed_txn_rate_30d": "failed_txn_rate_30d * 1.005D",
        "txn_count_7d": "nullif(txn_count_7d, 0D)",
        "avg_txn_amount_30d": "CASE WHEN avg_txn_amount_30d = 0 THEN double('NaN') ELSE avg_txn_amount_30d END",
        "total_spend_7d": "CASE WHEN plan_encoded = 3 THEN -1D ELSE total_spend_7d END",
    }
    return fx.snapshot(spark, folder).withColumns({c: F.expr(text) for c, text in changes.items()})


def validate_clean(spark, folder):
    return validation.clean(_dirty(spark, folder)).select("entity_id", "event_time", *fx.FEATURES)


def validate_batch(spark, folder):
    return _as_text(validation.validate(_dirty(spark, folder))).select("entity_id", "event_time", "violations")


def validation_violations(spark, folder):
    return validation.violation_counts(fx.quarters(spark, folder))


def quarantine_rows(spark, folder):
    rows = validation.quarantined_rows(fx.quarters(spark, folder))
    return _as_text(rows).select("entity_id", "event_time", "account_age_days", "violations")


def online_upsert(spark, folder):
    """Two writes of the table; the second finds rows of the first."""
    root = new_path(spark, "online")
    for rows in fx.online_batches(spark, folder):
        online_log.write_online(spark, root, rows, unique=True)
    return online_log.read_online(spark, root)


def _silent(spark, folder):
    return fx.snapshot(spark, folder).where("days_since_last_txn = 9999").select("entity_id")


def online_delete(spark, folder):
    return online.delete(fx.online_table(spark, folder), _silent(spark, folder))


def online_log_delete(spark, folder):
    """Writes, tombstones and a write after them in the stored table; the last write brings some entities back."""
    root = new_path(spark, "online")
    old, active = fx.online_batches(spark, folder)
    online_log.write_online(spark, root, old, unique=True)
    online_log.delete_online(spark, root, _silent(spark, folder))
    online_log.write_online(spark, root, active, unique=True, folders=2)
    return online_log.read_online(spark, root)


def online_lookup(spark, folder):
    return online.lookup(fx.online_table(spark, folder), fx.part_ids(spark, folder), READ_AT)


def online_size(spark, folder):
    return online.size(fx.online_table(spark, folder), READ_AT)


def dual_path_batch(spark, folder):
    return retrieval.dual_path_batch(
        fx.online_table(spark, folder), *mapping.raw(spark, folder), fx.part_ids(spark, folder), fx.SNAPSHOT
    )


def dual_path_summary(spark, folder):
    return retrieval.dual_path_summary(dual_path_batch(spark, folder))


def dual_path_no_online(spark, folder):
    """A table that was never written reads as empty: every id misses and is computed."""
    nothing = online_log.read_online(spark, new_path(spark, "absent"))
    return retrieval.dual_path_batch(
        nothing, *mapping.raw(spark, folder), fx.part_ids(spark, folder), fx.SNAPSHOT
    )


def materialize_latest(spark, folder):
    checked = online.materialize_rows(fx.quarters(spark, folder), fx.SNAPSHOT)
    good = online.as_online(checked.where("size(violations) = 0"), fx.SNAPSHOT)
    root = new_path(spark, "online")
    online_log.write_online(spark, root, good, unique=True)
    return online_log.read_online(spark, root)


def materialize_summary(spark, folder):
    entities = mapping.users(spark, folder).select("user_id")
    return online.materialize_summary(entities, online.materialize_rows(fx.quarters(spark, folder), fx.SNAPSHOT))


def stream_materialize(spark, folder):
    """History arrives in two parts; each refresh takes in what is new."""
    history, root, state = (new_path(spark, name) for name in ("history", "online", "state"))
    unique = fx.one_row_per_user(spark, folder)
    until, since = fx.SNAPSHOT, fx.SNAPSHOT + timedelta(microseconds=1)
    for part, bounds in zip(fx.quarters_split(spark, folder), ({"until": until}, {"since": since}), strict=True):
        tables.append_history(history, part, END, unique=unique, **bounds)
        refresh_online(spark, history, root, state, END)
    return online_log.read_online(spark, root)


QUERIES = {
    "validate_clean": validate_clean,
    "validate_batch": validate_batch,
    "validation_violations": validation_violations,
    "quarantine_rows": quarantine_rows,
    "online_upsert": online_upsert,
    "online_delete": online_delete,
    "online_log_delete": online_log_delete,
    "online_lookup": online_lookup,
    "online_size": online_size,
    "dual_path_batch": dual_path_batch,
    "dual_path_summary": dual_path_summary,
    "dual_path_no_online": dual_path_no_online,
    "materialize_latest": materialize_latest,
    "materialize_summary": materialize_summary,
    "stream_materialize": stream_materialize,
}

_DIRTY_SQL = """
dirty AS (
  SELECT * REPLACE (
    failed_txn_rate_30d * CAST(1.005 AS DOUBLE) AS failed_txn_rate_30d,
    nullif(txn_count_7d, 0) AS txn_count_7d,
    CASE WHEN avg_txn_amount_30d = 0 THEN CAST('NaN' AS DOUBLE) ELSE avg_txn_amount_30d END AS avg_txn_amount_30d,
    CASE WHEN plan_encoded = 3 THEN CAST(-1 AS DOUBLE) ELSE total_spend_7d END AS total_spend_7d)
  FROM fv
)"""
_LIVE = f"written_at > {sql.ts(READ_AT)} - INTERVAL 48 HOUR"
_IDS = "(SELECT DISTINCT p_partkey AS entity_id FROM part)"


def _dual(live: str) -> str:
    """Online rows under the condition `live`, computed rows for all other ids."""
    computed = ", ".join(f"CASE WHEN c.violations = '' THEN c.{f} END" for f in fx.FEATURES)
    return f"""
answers AS (
  SELECT i.entity_id, 'online_store' AS source, {fx.F13} FROM {_IDS} i JOIN online o USING (entity_id) WHERE {live}
  UNION ALL
  SELECT i.entity_id, CASE WHEN c.entity_id IS NULL THEN 'not_found' WHEN c.violations = '' THEN 'on_demand'
                           ELSE 'invalid' END, {computed}
  FROM {_IDS} i LEFT JOIN checked c USING (entity_id)
  WHERE i.entity_id NOT IN (SELECT entity_id FROM online WHERE {live})
)"""


_AT_SNAPSHOT = f"written_at > {sql.ts(fx.SNAPSHOT)} - INTERVAL 48 HOUR"
_LATEST_SQL = f"""
latest AS (
  SELECT * FROM h WHERE event_time <= {sql.ts(fx.SNAPSHOT)}
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY event_time DESC) = 1
)"""
_ONLINE_ROW = f"'user' AS entity_type, entity_id, 'v1' AS feature_version, {fx.F13}, event_time"

ORACLES = {
    "validate_clean": sql.with_(fx.SNAPSHOT_SQL, _DIRTY_SQL, sql.cleaned("checked", "dirty"))
    + f"SELECT entity_id, event_time, {fx.F13} FROM checked",
    "validate_batch": sql.with_(fx.SNAPSHOT_SQL, _DIRTY_SQL, sql.cleaned("checked", "dirty"))
    + "SELECT entity_id, event_time, violations FROM checked",
    "validation_violations": sql.with_(fx.QUARTERS_SQL, sql.cleaned("checked", "h")) + """
SELECT split_part(v, ':', 1) AS "column", split_part(v, ':', 2) AS rule, count(*) AS n_rows
FROM (SELECT unnest(string_split(violations, ',')) AS v FROM checked WHERE violations <> '') GROUP BY v""",
    "quarantine_rows": sql.with_(fx.QUARTERS_SQL, sql.cleaned("checked", "h"))
    + "SELECT entity_id, event_time, account_age_days, violations FROM checked WHERE violations <> ''",
    "online_upsert": sql.with_(fx.ONLINE_SQL) + "SELECT * FROM online",
    "online_delete": sql.with_(fx.ONLINE_SQL)
    + "SELECT * FROM online WHERE entity_id NOT IN (SELECT entity_id FROM fv WHERE days_since_last_txn = 9999)",
    "online_log_delete": sql.with_(fx.ONLINE_SQL) + """
SELECT * FROM batches
WHERE entity_id NOT IN (SELECT entity_id FROM fv WHERE days_since_last_txn = 9999)
   OR entity_id IN (SELECT entity_id FROM fv WHERE txn_count_90d > 0)
QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id, feature_version ORDER BY event_time DESC, written_at DESC) = 1""",
    "online_lookup": sql.with_(fx.ONLINE_SQL) + f"""
SELECT i.entity_id, o.entity_id IS NOT NULL AS hit, {fx.F13}
FROM {_IDS} i LEFT JOIN (SELECT * FROM online WHERE {_LIVE}) o ON o.entity_id = i.entity_id""",
    "online_size": sql.with_(fx.ONLINE_SQL) + f"SELECT count(*) AS entities FROM online WHERE {_LIVE}",
    "dual_path_batch": sql.with_(fx.ONLINE_SQL, sql.cleaned("checked", "fv"), _dual(_AT_SNAPSHOT))
    + "SELECT * FROM answers",
    "dual_path_summary": sql.with_(fx.ONLINE_SQL, sql.cleaned("checked", "fv"), _dual(_AT_SNAPSHOT)) + """
SELECT count(*) FILTER (source = 'online_store') AS hits, count(*) FILTER (source <> 'online_store') AS misses,
       count(*) FILTER (source = 'on_demand') AS on_demand_computed FROM answers""",
    "dual_path_no_online": sql.with_(fx.ONLINE_SQL, sql.cleaned("checked", "fv"), _dual("false"))
    + "SELECT * FROM answers",
    "materialize_latest": sql.with_(fx.QUARTERS_SQL, _LATEST_SQL, sql.cleaned("checked", "latest"))
    + f"SELECT {_ONLINE_ROW}, {sql.ts(fx.SNAPSHOT)} AS written_at FROM checked WHERE violations = ''",
    "materialize_summary": sql.with_(fx.QUARTERS_SQL, _LATEST_SQL, sql.cleaned("checked", "latest")) + """
SELECT total, processed, CAST(0 AS BIGINT) AS failed, validation_failures, total - with_history AS skipped,
       CASE WHEN validation_failures = 0 THEN 'success' WHEN processed > 0 THEN 'partial' ELSE 'failed' END AS status
FROM (SELECT count(DISTINCT user_id) AS total FROM raw_users),
     (SELECT count(*) FILTER (violations = '') AS processed, count(*) FILTER (violations <> '') AS validation_failures,
             count(*) AS with_history FROM checked)""",
    "stream_materialize": sql.with_(fx.QUARTERS_SQL, sql.cleaned("checked", "h")) + f"""
SELECT {_ONLINE_ROW}, {sql.ts(END)} AS written_at FROM checked WHERE violations = ''
QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY event_time DESC) = 1""",
}
