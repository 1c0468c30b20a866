"""Distribution statistics and drift."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import distribution
from tidemark.plans import fixtures as fx
from tidemark.plans import sql
from tidemark.schemas import KS_THRESHOLD, SKEW_BASELINES
from tidemark.session import new_path
from tidemark.sources import tables

STATS = ["mean", "std", "p25", "p50", "p75", "p95", "null_rate"]
BEFORE = fx.TRAINED_AT - timedelta(days=7)


def feature_stats(spark, folder):
    rows = distribution.window_rows(fx.stored_history(spark, folder, fx.TRAINING_WEEK), fx.TRAINED_AT, 7)
    return fx.rounded(distribution.feature_stats(rows), *STATS)


def null_rate(spark, folder):
    """A quarter of history in which missing values stand for missing transactions."""
    rows = fx.quarters(spark, folder).withColumns({
        "txn_count_30d": F.expr("nullif(txn_count_30d, 0D)"),
        "avg_txn_amount_30d": F.expr("CASE WHEN txn_count_30d = 0 THEN double('NaN') ELSE avg_txn_amount_30d END"),
    })
    return fx.rounded(distribution.null_rate(rows), "null_rate")


def _training_snapshot(spark, folder, at, name):
    history = fx.stored_history(spark, folder, dict(fx.TRAINING_WEEK, now=at))
    return distribution.skew_snapshot(history, "training", at, 7, name)


def skew_snapshot_training(spark, folder):
    return fx.rounded(_training_snapshot(spark, folder, fx.TRAINED_AT, "train-b"), *STATS)


def skew_snapshot_serving(spark, folder):
    history = fx.stored_history(spark, folder, fx.SERVING_DAY)
    return fx.rounded(distribution.skew_snapshot(history, "serving", fx.SNAPSHOT, 1, "serve-a"), *STATS)


def skew_latest_training(spark, folder):
    log = _training_snapshot(spark, folder, BEFORE, "train-a").unionByName(
        _training_snapshot(spark, folder, fx.TRAINED_AT, "train-b")
    )
    return fx.rounded(distribution.latest_snapshot(log, "training"), *STATS)


def skew_summary(spark, folder):
    training, serving = fx.drift_windows(spark, folder)
    return distribution.skew_summary(distribution.feature_stats(training), distribution.feature_stats(serving))


def _long(spark, folder):
    return [distribution.long_form(rows) for rows in fx.drift_windows(spark, folder)]


def ks_statistic(spark, folder):
    return fx.rounded(distribution.ks_statistic(*_long(spark, folder)), "ks_statistic")


def ks_pvalue(spark, folder):
    return fx.rounded(distribution.ks_test(*_long(spark, folder)), "ks_statistic", "ks_pvalue")


def skew_report(spark, folder):
    return distribution.skew_report(*fx.drift_windows(spark, folder))


def skew_report_logged(spark, folder):
    """Against baselines stored when the model was trained, the later of two; no training history is read again."""
    log = new_path(spark, "baselines")
    for at, name in ((BEFORE, "train-a"), (fx.TRAINED_AT, "train-b")):
        history = fx.history(spark, folder, dict(fx.TRAINING_WEEK, now=at))
        tables.append(log, distribution.baseline(history, "training", at, 7, name))
    stored = tables.read(spark, log, SKEW_BASELINES)
    serving = distribution.window_rows(fx.stored_history(spark, folder, fx.SERVING_DAY), fx.SNAPSHOT, 1)
    return distribution.skew_report_of(distribution.latest_baseline(stored, "training"), distribution.long_form(serving))


def skew_flag_counts(spark, folder):
    return distribution.skew_flag_counts(skew_report(spark, folder))


QUERIES = {
    "feature_stats": feature_stats,
    "null_rate": null_rate,
    "skew_snapshot_training": skew_snapshot_training,
    "skew_snapshot_serving": skew_snapshot_serving,
    "skew_latest_training": skew_latest_training,
    "skew_summary": skew_summary,
    "ks_statistic": ks_statistic,
    "ks_pvalue": ks_pvalue,
    "skew_report": skew_report,
    "skew_report_logged": skew_report_logged,
    "skew_flag_counts": skew_flag_counts,
}

_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in STATS)
_TRAIN = sql.RAW + "," + sql.history("ht", **fx.TRAINING_WEEK)
_TRAIN_STATS = _TRAIN + "," + sql.stats("tr", "ht", "true")
_SERVE = sql.history("hs", **fx.SERVING_DAY)
_BOTH_STATS = _TRAIN_STATS + "," + _SERVE + "," + sql.stats("sv", "hs", "true")
_NULLED = """
rows_in AS (
  SELECT * REPLACE (nullif(txn_count_30d, 0) AS txn_count_30d,
                    CASE WHEN txn_count_30d = 0 THEN CAST('NaN' AS DOUBLE) ELSE avg_txn_amount_30d END AS avg_txn_amount_30d)
  FROM h
)"""
_SUMMARY = """
summary AS (
  SELECT feature_name, round(tr.mean, 4) AS training_mean, round(tr.std, 4) AS training_std,
         round(tr.p50, 4) AS training_p50, round(sv.mean, 4) AS serving_mean, round(sv.std, 4) AS serving_std,
         round(sv.p50, 4) AS serving_p50,
         round(abs(tr.mean - sv.mean) / greatest(tr.std, 1e-6), 4) AS mean_shift,
         tr.sample_count AS training_sample_count, sv.sample_count AS serving_sample_count
  FROM tr JOIN sv USING (feature_name)
)"""
_KS = """
pooled AS (
  SELECT feature_name, value, count(*) FILTER (side = 'a') AS a, count(*) FILTER (side = 'b') AS b
  FROM (SELECT *, 'a' AS side FROM tr_long UNION ALL SELECT *, 'b' AS side FROM sv_long)
  WHERE value IS NOT NULL GROUP BY feature_name, value
),
steps AS (
  SELECT feature_name, sum(a) OVER up AS ca, sum(b) OVER up AS cb, sum(a) OVER w AS na, sum(b) OVER w AS nb
  FROM pooled WINDOW up AS (PARTITION BY feature_name ORDER BY value), w AS (PARTITION BY feature_name)
),
ks AS (
  SELECT feature_name, max(abs(ca / na - cb / nb)) AS d, CAST(max(na) AS BIGINT) AS n_training,
         CAST(max(nb) AS BIGINT) AS n_serving
  FROM steps GROUP BY feature_name
),
scaled AS (
  SELECT *, sqrt(CAST(n_training AS DOUBLE) * n_serving / (CAST(n_training AS DOUBLE) + n_serving)) * d AS x FROM ks
),
tested AS (
  SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 * list_sum(list_transform(range(1, 101),
           lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(CAST(-2.0 AS DOUBLE) * k * k * x * x))))) END AS p
  FROM scaled
)"""
_REPORT = f"""
report AS (
  SELECT s.*, round(d, 4) AS ks_statistic, round(CAST(p AS DOUBLE), 4) AS ks_pvalue, p < {KS_THRESHOLD} AS flagged
  FROM summary s JOIN tested USING (feature_name)
)"""


def _snapshot_row(name: str, context: str, at) -> str:
    return (
        f"SELECT '{name}' AS snapshot_id, feature_name, 'v1' AS feature_version, '{context}' AS context, "
        f"{_ROUNDED}, sample_count, {sql.ts(at)} AS captured_at FROM "
    )


ORACLES = {
    "feature_stats": sql.with_(_TRAIN_STATS) + f"SELECT feature_name, {_ROUNDED}, sample_count FROM tr",
    "null_rate": sql.with_(fx.QUARTERS_SQL, _NULLED) + " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, count(*) AS sample_count, count(*) FILTER ({c} IS NULL OR isnan({c})) AS n_missing,"
        f" round(count(*) FILTER ({c} IS NULL OR isnan({c})) / greatest(count(*), 1), 6) AS null_rate FROM rows_in"
        for c in fx.FEATURES
    ),
    "skew_snapshot_training": sql.with_(_TRAIN_STATS) + _snapshot_row("train-b", "training", fx.TRAINED_AT) + "tr",
    "skew_snapshot_serving": sql.with_(sql.RAW, _SERVE, sql.stats("sv", "hs", "true"))
    + _snapshot_row("serve-a", "serving", fx.SNAPSHOT) + "sv",
    "skew_latest_training": sql.with_(
        _TRAIN_STATS, sql.history("he", **dict(fx.TRAINING_WEEK, now=BEFORE)), sql.stats("te", "he", "true")
    ) + f"""
SELECT * FROM ({_snapshot_row('train-a', 'training', BEFORE)} te
               UNION ALL {_snapshot_row('train-b', 'training', fx.TRAINED_AT)} tr)
QUALIFY row_number() OVER (PARTITION BY feature_name ORDER BY captured_at DESC) = 1""",
    "skew_summary": sql.with_(_BOTH_STATS, _SUMMARY) + "SELECT * FROM summary",
    "ks_statistic": sql.with_(_BOTH_STATS, _KS)
    + "SELECT feature_name, round(d, 6) AS ks_statistic, n_training, n_serving FROM ks",
    "ks_pvalue": sql.with_(_BOTH_STATS, _KS) + """
SELECT feature_name, round(d, 6) AS ks_statistic, n_training, n_serving, round(CAST(p AS DOUBLE), 6) AS ks_pvalue
FROM tested""",
    "skew_report": sql.with_(_BOTH_STATS, _SUMMARY, _KS, _REPORT)
    + "SELECT * FROM report ORDER BY flagged DESC, ks_statistic DESC, feature_name",
    "skew_report_logged": sql.with_(_BOTH_STATS, _SUMMARY, _KS, _REPORT)
    + "SELECT * FROM report ORDER BY flagged DESC, ks_statistic DESC, feature_name",
    "skew_flag_counts": sql.with_(_BOTH_STATS, _SUMMARY, _KS, _REPORT)
    + "SELECT count(*) FILTER (flagged) AS flagged, count(*) AS total FROM report",
}
