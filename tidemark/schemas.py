"""Schemas of the stored tables, as DDL. All times are wall-clock UTC without a zone."""

from __future__ import annotations

# Feature names in their stored order, window lengths, the default recency,
# plan codes, online lifetime and drift threshold.
FEATURES = [
    "txn_count_7d",
    "txn_count_30d",
    "txn_count_90d",
    "total_spend_7d",
    "total_spend_30d",
    "total_spend_90d",
    "avg_txn_amount_30d",
    "failed_txn_rate_30d",
    "days_since_last_txn",
    "open_tickets",
    "ticket_rate_30d",
    "account_age_days",
    "plan_encoded",
]
WINDOW_DAYS = (7, 30, 90)
NEVER_TRANSACTED = 9999
PLAN_CODES = {"free": 0, "basic": 1, "pro": 2}
OTHER_PLAN_CODE = 3
ONLINE_TTL_HOURS = 48
KS_THRESHOLD = 0.05
ENTITY_TYPE = "user"
VERSION = "v1"


_FEATURE_DDL = ", ".join(f"{name} double" for name in FEATURES)

RAW_USERS = (
    "user_id bigint, signup_date date, country string, plan_type string, age_bucket string, "
    "created_at timestamp_ntz"
)
RAW_TRANSACTIONS = (
    "transaction_id bigint, user_id bigint, amount double, category string, status string, "
    "event_time timestamp_ntz"
)
RAW_SUPPORT_TICKETS = (
    "ticket_id bigint, user_id bigint, severity string, resolved int, event_time timestamp_ntz"
)
# feature_version and snapshot_id are the folders of the stored table.
FEATURE_HISTORY = (
    f"entity_id bigint, entity_type string, event_time timestamp_ntz, {_FEATURE_DDL}, "
    "computed_at timestamp_ntz, feature_version string, snapshot_id string"
)
HISTORY_KEY = ["entity_id", "feature_version", "event_time"]
FEATURE_REGISTRY = (
    "feature_name string, entity_type string, dtype string, description string, "
    "source_table string, transformation string, owner string, tags array<string>, is_active int, "
    "created_at timestamp_ntz, deprecated_at timestamp_ntz, feature_version string"
)
LINEAGE_EDGES = (
    "source_node string, target_node string, edge_type string, created_at timestamp_ntz, "
    "feature_version string"
)
MATERIALIZATION_LOG = (
    "run_id string, feature_version string, entity_type string, entities_processed bigint, "
    "entities_failed bigint, duration_ms bigint, status string, error_message string, "
    "started_at timestamp_ntz, completed_at timestamp_ntz"
)
SKEW_SNAPSHOTS = (
    "snapshot_id string, feature_name string, feature_version string, context string, "
    "mean double, std double, p25 double, p50 double, p75 double, p95 double, null_rate double, "
    "sample_count bigint, captured_at timestamp_ntz"
)
# The values of a window with their numbers of rows: what a later comparison needs of it.
SKEW_BASELINES = (
    "snapshot_id string, feature_name string, feature_version string, context string, value double, n bigint, "
    "captured_at timestamp_ntz"
)
ONLINE_FEATURES = (
    f"entity_type string, entity_id bigint, feature_version string, {_FEATURE_DDL}, "
    "event_time timestamp_ntz, written_at timestamp_ntz"
)
ONLINE_KEY = ["entity_type", "entity_id", "feature_version"]
REQUEST_LOG = "path string, latency_ms double, hit boolean, ts timestamp_ntz"

TABLES = {
    "raw_users": RAW_USERS,
    "raw_transactions": RAW_TRANSACTIONS,
    "raw_support_tickets": RAW_SUPPORT_TICKETS,
    "feature_history": FEATURE_HISTORY,
    "feature_registry": FEATURE_REGISTRY,
    "lineage_edges": LINEAGE_EDGES,
    "materialization_log": MATERIALIZATION_LOG,
    "skew_snapshots": SKEW_SNAPSHOTS,
    "skew_baselines": SKEW_BASELINES,
    "online_features": ONLINE_FEATURES,
    "request_log": REQUEST_LOG,
}
