"""Labels, training sets, leakage and model quality."""

from __future__ import annotations

from tidemark.operators import model_quality, training
from tidemark.plans import fixtures as fx
from tidemark.plans import sql
from tidemark.session import stage
from tidemark.sources import mapping

FIRST_N = 100
AS_OF = fx.QUARTERS["now"]


def churn_labels_first_n(spark, folder):
    """The report of the users with the smallest ids among the labelled ones."""
    users, transactions = mapping.users(spark, folder), mapping.transactions(spark, folder)
    return training.churn_labels(
        users, transactions, fx.SNAPSHOT, fx.LABEL_WINDOW_DAYS, fx.MIN_BEFORE, first_n=FIRST_N
    )


def label_rate(spark, folder):
    return fx.rounded(training.label_rate(fx.churn(spark, folder)), "churn_rate")


def _labelled(spark, folder):
    """Churn labels, stored, and the history of the users they name."""
    labels = stage(fx.churn(spark, folder), "labels")
    return labels, fx.labelled_history(spark, folder, labels, fx.QUARTERS)


def _pit(labels, history):
    """The point-in-time join reads history more than once, so it gets it as a store holds it."""
    return training.pit_training_set(labels, stage(history, "history"))


def pit_training_set(spark, folder):
    return _pit(*_labelled(spark, folder))


def naive_training_set(spark, folder):
    return training.naive_training_set(*_labelled(spark, folder), AS_OF)


def leakage_audit(spark, folder):
    return training.leakage_audit(fx.ticket_labels(spark, folder), fx.stored_history(spark, folder, fx.QUARTERS), AS_OF)


def stratified_split(spark, folder):
    return model_quality.stratified_split(fx.churn(spark, folder)).select("entity_id", "churned", "part")


def class_weights(spark, folder):
    return model_quality.class_weights(fx.churn(spark, folder))


def _scored(spark, folder):
    """Stored scores, made from recency: the longer a user has been silent, the likelier they have left."""
    return stage(pit_training_set(spark, folder).selectExpr("churned", "days_since_last_txn / 90D AS score"), "scores")


def auc_rank(spark, folder):
    return fx.rounded(model_quality.auc(_scored(spark, folder)), "roc_auc")


def average_precision(spark, folder):
    return fx.rounded(model_quality.average_precision(_scored(spark, folder)), "average_precision")


def f1_score(spark, folder):
    return fx.rounded(model_quality.f1_score(_scored(spark, folder)), "f1")


def _split(spark, folder):
    """The split reads the set for its cut and for its rows, with other columns each time: so it is stored before."""
    return stage(model_quality.stratified_split(stage(pit_training_set(spark, folder), "set")), "split")


def churn_model_scores(spark, folder):
    """Trees fitted on the train part score the test part; fitting reads the set many times."""
    split = _split(spark, folder)
    model = model_quality.fit_churn_model(split.where("part = 'train'"))
    return model_quality.score_churn(model, split.where("part = 'test'")).select("entity_id", "churned", "score")


def churn_model_coverage(spark, folder):
    """Which rows the fitted model scores, and whether each score is a probability."""
    return churn_model_scores(spark, folder).selectExpr("entity_id", "churned", "score >= 0 AND score <= 1 AS scored")


_SHARES = {c: f"{c} >= 0 AND {c} <= 1" for c in ("roc_auc", "average_precision", "f1")}


def _compared(spark, folder):
    labels, history = _labelled(spark, folder)
    sets = {
        "point_in_time": _pit(labels, history),
        "naive": training.naive_training_set(labels, history, AS_OF),
    }
    scores = model_quality.score_models(sets, rounds=5, depth=3)
    return model_quality.compare_models(scores)


def model_comparison(spark, folder):
    """A model on point-in-time features beside one on the newest, with the quality of both."""
    return _compared(spark, folder)


def model_comparison_checked(spark, folder):
    """The comparison with its measures checked for their range; the measures themselves come from fitted trees."""
    rows = _compared(spark, folder)
    return rows.selectExpr("training_set", "n_train", "n_test", "n_test_positive", "fitted", *[f"{text} AS {c}_is_share" for c, text in _SHARES.items()])


def _permuted(spark, folder):
    split = _split(spark, folder)
    model = model_quality.fit_churn_model(split.where("part = 'train'"), rounds=5, depth=3)
    return model_quality.permutation_importance(model, split.where("part = 'test'"))


def permutation_importance(spark, folder):
    return _permuted(spark, folder)


def permutation_importance_checked(spark, folder):
    return _permuted(spark, folder).selectExpr("feature_name", "roc_auc >= 0 AND roc_auc <= 1 AS roc_auc_is_share", "abs(importance) <= 1 AS importance_fits")


QUERIES = {
    "churn_labels": fx.churn,
    "churn_labels_first_n": churn_labels_first_n,
    "label_rate": label_rate,
    "pit_training_set": pit_training_set,
    "naive_training_set": naive_training_set,
    "leakage_audit": leakage_audit,
    "stratified_split": stratified_split,
    "class_weights": class_weights,
    "auc_rank": auc_rank,
    "average_precision": average_precision,
    "f1_score": f1_score,
    "churn_model_scores": churn_model_scores,
    "churn_model_coverage": churn_model_coverage,
    "model_comparison": model_comparison,
    "model_comparison_checked": model_comparison_checked,
    "permutation_importance": permutation_importance,
    "permutation_importance_checked": permutation_importance_checked,
}

_FILLED = ", ".join(f"coalesce(h.{c}, 0) AS {c}" for c in fx.FEATURES)
_LABEL = "l.entity_id, l.label_time, l.txns_before, l.txns_after, l.churned"
_PIT = f"""
pit AS (
  SELECT {_LABEL}, h.event_time AS feature_time, {_FILLED}
  FROM churn l ASOF LEFT JOIN h ON l.entity_id = h.entity_id AND l.label_time >= h.event_time
)"""
_SCORED = "scored AS (SELECT churned, days_since_last_txn / CAST(90 AS DOUBLE) AS score FROM pit)"
_NEWEST = f"""
newest AS (
  SELECT * FROM h WHERE event_time <= {sql.ts(AS_OF)}
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY event_time DESC) = 1
)"""
_WITH_SCORED = sql.with_(fx.QUARTERS_SQL, fx.CHURN_SQL, _PIT, _SCORED)
_LEAK = " UNION ALL ".join(
    f"""
SELECT '{c}' AS feature_name, count(*) AS n_labels, count(*) FILTER (late) AS n_late,
       count(*) FILTER (late AND naive_{c} <> {c}) AS n_changed,
       round(avg(abs(naive_{c} - {c})) FILTER (late), 4) AS mean_shift FROM pairs"""
    for c in fx.FEATURES
)
_PAIRS = f"""
tickets AS (SELECT user_id AS entity_id, event_time AS label_time FROM raw_support_tickets),
known AS (
  SELECT l.entity_id, l.label_time, {_FILLED}
  FROM tickets l ASOF LEFT JOIN h ON l.entity_id = h.entity_id AND l.label_time >= h.event_time
),
pairs AS (
  SELECT k.*, n.event_time > k.label_time AS late, {', '.join(f'coalesce(n.{c}, 0) AS naive_{c}' for c in fx.FEATURES)}
  FROM known k JOIN newest n ON n.entity_id = k.entity_id
)"""

_PARTS = f"""
SELECT entity_id, churned,
       CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY md5(entity_id || '-{model_quality.SEED}'))
                 <= floor(count(*) OVER (PARTITION BY churned) * CAST({model_quality.TEST_SHARE} AS DOUBLE))
            THEN 'test' ELSE 'train' END AS part
FROM """
_COUNTED = """SELECT '{0}' AS training_set, count(*) FILTER (part = 'train') AS n_train, count(*) FILTER (part = 'test') AS n_test,
       count(*) FILTER (part = 'test' AND churned = 1) AS n_test_positive,
       count(DISTINCT churned) FILTER (part = 'train') = 2 AS fitted, true AS roc_auc_is_share,
       true AS average_precision_is_share, true AS f1_is_share FROM ({1})"""

ORACLES = {
    "churn_model_coverage": sql.with_(fx.QUARTERS_SQL, fx.CHURN_SQL, _PIT)
    + f"SELECT entity_id, churned, true AS scored FROM ({_PARTS} pit) WHERE part = 'test'",
    "model_comparison_checked": sql.with_(fx.QUARTERS_SQL, fx.CHURN_SQL, _PIT, _NEWEST)
    + _COUNTED.format("point_in_time", _PARTS + "pit") + " UNION ALL "
    + _COUNTED.format("naive", _PARTS + "(SELECT l.entity_id, l.churned FROM churn l JOIN newest h ON h.entity_id = l.entity_id)"),
    "permutation_importance_checked": " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, count(*) > 0 AS roc_auc_is_share, count(*) > 0 AS importance_fits FROM orders" for c in fx.FEATURES
    ),
    "churn_labels": sql.with_(sql.RAW, fx.CHURN_SQL) + "SELECT * FROM churn",
    "churn_labels_first_n": sql.with_(sql.RAW, fx.CHURN_SQL)
    + f"SELECT * FROM churn ORDER BY entity_id LIMIT {FIRST_N}",
    "label_rate": sql.with_(sql.RAW, fx.CHURN_SQL) + """
SELECT count(*) AS n_labels, CAST(sum(churned) AS BIGINT) AS n_churned, round(avg(churned), 6) AS churn_rate,
       count(DISTINCT churned) AS n_classes, count(DISTINCT churned) >= 2 AS trainable FROM churn""",
    "pit_training_set": sql.with_(fx.QUARTERS_SQL, fx.CHURN_SQL, _PIT) + "SELECT * FROM pit",
    "naive_training_set": sql.with_(fx.QUARTERS_SQL, fx.CHURN_SQL, _NEWEST)
    + f"SELECT {_LABEL}, h.event_time AS feature_time, {_FILLED} FROM churn l JOIN newest h ON h.entity_id = l.entity_id",
    "leakage_audit": sql.with_(fx.QUARTERS_SQL, _NEWEST, _PAIRS) + _LEAK,
    "stratified_split": sql.with_(sql.RAW, fx.CHURN_SQL) + f"""
SELECT entity_id, churned,
       CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY md5(entity_id || '-{model_quality.SEED}'))
                 <= floor(count(*) OVER (PARTITION BY churned) * CAST({model_quality.TEST_SHARE} AS DOUBLE))
            THEN 'test' ELSE 'train' END AS part
FROM churn""",
    "class_weights": sql.with_(sql.RAW, fx.CHURN_SQL) + """
SELECT churned, count(*) AS n_class,
       (SELECT count(*) FROM churn) / ((SELECT count(DISTINCT churned) FROM churn) * count(*)) AS weight
FROM churn GROUP BY churned""",
    "auc_rank": _WITH_SCORED + """
SELECT round((sum(r) FILTER (churned = 1) - np * (np + 1) / 2) / np / nn, 6) AS roc_auc,
       np AS n_positive, nn AS n_negative
FROM (
  SELECT churned, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r,
         count(*) FILTER (churned = 1) OVER () AS np, count(*) FILTER (churned = 0) OVER () AS nn
  FROM scored
) GROUP BY np, nn""",
    "average_precision": _WITH_SCORED + """
SELECT round(sum(pos * tp / n) / max(tp), 6) AS average_precision
FROM (
  SELECT pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(cnt) OVER (ORDER BY score DESC) AS n
  FROM (SELECT score, count(*) FILTER (churned = 1) AS pos, count(*) AS cnt FROM scored GROUP BY score)
)""",
    "f1_score": _WITH_SCORED + """
SELECT tp, fp, fn, tn, round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1
FROM (
  SELECT count(*) FILTER (score > 0.5 AND churned = 1) AS tp, count(*) FILTER (score > 0.5 AND churned = 0) AS fp,
         count(*) FILTER (score <= 0.5 AND churned = 1) AS fn, count(*) FILTER (score <= 0.5 AND churned = 0) AS tn
  FROM scored
)""",
}
