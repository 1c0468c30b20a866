"""Churn labels, training sets with and without leakage, and the audit of the difference."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import in_window, moment_sql, per_feature
from tidemark.operators.asof import latest_asof, pit_join
from tidemark.operators.features import SUCCESS
from tidemark.operators.sizing import restrict_to_ids
from tidemark.schemas import FEATURES, VERSION


def churn_labels(
    users: DataFrame, transactions: DataFrame, label_time: datetime, window_days: int = 30, min_before: int = 5,
    first_n: int | None = None,
) -> DataFrame:
    """Users active before `label_time`, labelled 1 if they fell silent afterwards.

    Churned means at least `min_before` successes in the window before and none in the window
    after. `first_n` keeps the users with the smallest ids.
    """
    end = label_time + timedelta(days=window_days)
    cut = moment_sql(label_time)
    counts = (
        transactions.where(SUCCESS).where(in_window("event_time", end, 2 * window_days))
        .groupBy("user_id")
        .agg(
            F.expr(f"count_if(event_time < {cut})").alias("txns_before"),
            F.expr(f"count_if(event_time >= {cut})").alias("txns_after"),
        )
        .where("txns_before > 0")
    )
    labels = users.select("user_id").join(counts, "user_id").selectExpr(
        "user_id AS entity_id",
        f"{cut} AS label_time",
        "txns_before",
        "txns_after",
        f"int(txns_after = 0 AND txns_before >= {min_before}) AS churned",
    )
    return labels if first_n is None else labels.orderBy("entity_id").limit(first_n)


def label_rate(labels: DataFrame) -> DataFrame:
    """Size and class balance; a set with one class only cannot train a model."""
    return labels.agg(
        F.count(F.lit(1)).alias("n_labels"),
        F.sum("churned").alias("n_churned"),
        F.avg("churned").alias("churn_rate"),
        F.count_distinct("churned").alias("n_classes"),
    ).withColumn("trainable", F.col("n_classes") >= 2)


def fill_missing(df: DataFrame) -> DataFrame:
    """Missing features as 0, as a step of its own after the join that left them missing."""
    return df.na.fill(0.0, FEATURES)


def pit_training_set(labels: DataFrame, history: DataFrame, version: str = VERSION) -> DataFrame:
    """Labels with the features known at their own time; the label columns travel along."""
    return fill_missing(pit_join(labels, history, version))


def _newest(labels: DataFrame, history: DataFrame, as_of: datetime, version: str) -> DataFrame:
    (found,) = restrict_to_ids(labels.select("entity_id").distinct(), "entity_id", history)
    return latest_asof(found, as_of, version)


def naive_training_set(
    labels: DataFrame, history: DataFrame, as_of: datetime, version: str = VERSION
) -> DataFrame:
    """Labels with the newest features at `as_of`, which may lie after the label: the mistake
    that `leakage_audit` measures. Labels without any history drop out."""
    newest = _newest(labels, history, as_of, version).select(
        "entity_id", F.col("event_time").alias("feature_time"), *FEATURES
    )
    return fill_missing(labels.join(newest, "entity_id"))


def leakage_audit(
    labels: DataFrame, history: DataFrame, as_of: datetime, version: str = VERSION
) -> DataFrame:
    """Per feature: labels whose naive value comes from after the label, and how far it is off.

    One latest-row lookup per entity is joined to the point-in-time set; labels are read once.
    """
    newest = _newest(labels, history, as_of, version).selectExpr(
        "entity_id", "event_time AS naive_time", *[f"coalesce({c}, 0D) AS naive_{c}" for c in FEATURES]
    )
    both = pit_training_set(labels, history, version).join(newest, "entity_id")
    late = "naive_time > label_time"
    sums = both.agg(
        F.count(F.lit(1)).alias("n_labels"),
        F.expr(f"count_if({late})").alias("n_late"),
        *[F.expr(f"count_if({late} AND naive_{c} <> {c})").alias(f"n_{c}") for c in FEATURES],
        *[F.expr(f"avg(CASE WHEN {late} THEN abs(naive_{c} - {c}) END)").alias(f"d_{c}") for c in FEATURES],
    )
    columns = {"n_changed": "n_{}", "mean_shift": "round(d_{}, 4)"}
    return per_feature(sums, FEATURES, columns, "n_labels", "n_late")
