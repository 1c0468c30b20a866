"""Feature definitions and declared lineage, as rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import moment
from tidemark.schemas import ENTITY_TYPE, FEATURE_REGISTRY, FEATURES, LINEAGE_EDGES, VERSION

# Type label, owner, source table and tags of each feature, and the model that
# reads the features with its declared inputs.
DTYPE = "float32"
OWNER = "ml-platform"
SOURCE_AND_TAGS = {
    "txn_count_7d": ("raw_transactions", ["behavioral", "transaction", "short-term"]),
    "txn_count_30d": ("raw_transactions", ["behavioral", "transaction", "medium-term"]),
    "txn_count_90d": ("raw_transactions", ["behavioral", "transaction", "long-term"]),
    "total_spend_7d": ("raw_transactions", ["behavioral", "spend", "short-term"]),
    "total_spend_30d": ("raw_transactions", ["behavioral", "spend", "medium-term"]),
    "total_spend_90d": ("raw_transactions", ["behavioral", "spend", "long-term"]),
    "avg_txn_amount_30d": ("raw_transactions", ["behavioral", "spend", "medium-term"]),
    "failed_txn_rate_30d": ("raw_transactions", ["behavioral", "transaction", "risk"]),
    "days_since_last_txn": ("raw_transactions", ["behavioral", "recency"]),
    "open_tickets": ("raw_support_tickets", ["support", "risk"]),
    "ticket_rate_30d": ("raw_support_tickets", ["support", "medium-term"]),
    "account_age_days": ("raw_users", ["profile", "static"]),
    "plan_encoded": ("raw_users", ["profile", "static"]),
}
MODEL = "churn_predictor_v1"
MODEL_INPUTS = [
    "txn_count_30d",
    "total_spend_30d",
    "avg_txn_amount_30d",
    "failed_txn_rate_30d",
    "days_since_last_txn",
    "open_tickets",
    "ticket_rate_30d",
    "account_age_days",
    "plan_encoded",
]

# Description of each feature and how it is computed.
MEANING = {
    "txn_count_7d": ("Successful transactions in the week before the snapshot", "count_if(success) over 7 days"),
    "txn_count_30d": ("Successful transactions in the 30 days before the snapshot", "count_if(success) over 30 days"),
    "txn_count_90d": ("Successful transactions in the 90 days before the snapshot", "count_if(success) over 90 days"),
    "total_spend_7d": ("Money spent in the week before the snapshot", "sum(amount if success) over 7 days"),
    "total_spend_30d": ("Money spent in the 30 days before the snapshot", "sum(amount if success) over 30 days"),
    "total_spend_90d": ("Money spent in the 90 days before the snapshot", "sum(amount if success) over 90 days"),
    "avg_txn_amount_30d": ("Mean amount of a successful transaction, 30 days", "spend / count over 30 days, else 0"),
    "failed_txn_rate_30d": ("Share of failed transactions, 30 days", "count_if(failed) / greatest(count, 1)"),
    "days_since_last_txn": ("Midnights since the last successful transaction", "datediff(snapshot, last), else 9999"),
    "open_tickets": ("Unresolved support tickets opened before the snapshot", "count_if(resolved = 0)"),
    "ticket_rate_30d": ("Support tickets opened in the 30 days before the snapshot", "count over 30 days"),
    "account_age_days": ("Midnights since sign-up", "datediff(snapshot, signup_date)"),
    "plan_encoded": ("Plan as a number, higher for larger plans", "plan code, 3 if missing or unknown"),
}


def registry_rows(spark: SparkSession, created_at: datetime, version: str = VERSION) -> DataFrame:
    rows = [
        (name, ENTITY_TYPE, DTYPE, *MEANING[name], SOURCE_AND_TAGS[name][0], OWNER, SOURCE_AND_TAGS[name][1])
        for name in FEATURES
    ]
    defined = spark.createDataFrame(
        rows,
        "feature_name string, entity_type string, dtype string, description string, transformation string, "
        "source_table string, owner string, tags array<string>",
    )
    return defined.withColumns({
        "is_active": F.lit(1),
        "created_at": moment(created_at),
        "deprecated_at": F.lit(None).cast("timestamp_ntz"),
        "feature_version": F.lit(version),
    }).select(*_names(FEATURE_REGISTRY))


def lineage_rows(spark: SparkSession, created_at: datetime, version: str = VERSION) -> DataFrame:
    edges = [(SOURCE_AND_TAGS[name][0], name, "source") for name in FEATURES]
    edges += [(name, MODEL, "model_input") for name in MODEL_INPUTS]
    return (
        spark.createDataFrame(edges, "source_node string, target_node string, edge_type string")
        .withColumns({"created_at": moment(created_at), "feature_version": F.lit(version)})
        .select(*_names(LINEAGE_EDGES))
    )


def _names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]
