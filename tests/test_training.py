import hashlib
import random
from datetime import date, datetime, timedelta

import pytest
from raw_data import NOW

from tidemark.operators import model_quality as q
from tidemark.operators import run_log, training
from tidemark.plans import fixtures as fx
from tidemark.plans import training_queries

DAY = timedelta(days=1)
SCORED = "entity_id bigint, churned int, score double"


def test_labels(make_raw):
    users = [(i, date(2024, 1, 1), "pro") for i in (1, 2, 3, 4)]
    before = [(u, 1, "success", NOW - i * DAY) for u, n in ((1, 5), (2, 4), (3, 6)) for i in range(1, n + 1)]
    other = [(3, 1, "success", NOW), (1, 1, "failed", NOW + DAY), (4, 1, "success", NOW - 31 * DAY), (1, 1, "success", NOW + 30 * DAY)]
    raw = make_raw(users, before + other)
    rows = training.churn_labels(raw[0], raw[1], NOW)
    assert sorted((r.entity_id, r.txns_before, r.txns_after, r.churned) for r in rows.collect()) == [
        (1, 5, 0, 1), (2, 4, 0, 0), (3, 6, 1, 0)
    ]
    assert [r.entity_id for r in training.churn_labels(raw[0], raw[1], NOW, first_n=2).collect()] == [1, 2]
    assert training.label_rate(rows).first().asDict() == {
        "n_labels": 3, "n_churned": 1, "churn_rate": 1 / 3, "n_classes": 2, "trainable": True
    }


def test_training_sets_and_leakage(spark, make_history):
    history = make_history([
        (1, datetime(2024, 1, 1), {"txn_count_7d": 5.0}), (1, datetime(2024, 3, 1), {"txn_count_7d": 999.0}),
        (2, datetime(2024, 1, 1), {"txn_count_7d": 7.0}),
    ])
    labels = spark.createDataFrame(
        [(1, datetime(2024, 2, 1), 1), (1, datetime(2024, 4, 1), 0), (2, datetime(2024, 2, 1), 0), (3, datetime(2024, 2, 1), 0)],
        "entity_id bigint, label_time timestamp_ntz, churned int",
    )
    pit = training.pit_training_set(labels, history).collect()
    assert sorted((r.entity_id, r.churned, r.txn_count_7d) for r in pit) == [(1, 0, 999.0), (1, 1, 5.0), (2, 0, 7.0), (3, 0, 0.0)]
    assert all(r.feature_time is None or r.feature_time <= r.label_time for r in pit)
    naive = training.naive_training_set(labels, history, datetime(2024, 6, 1)).collect()
    assert sorted((r.entity_id, r.churned, r.txn_count_7d) for r in naive) == [(1, 0, 999.0), (1, 1, 999.0), (2, 0, 7.0)]
    audit = {r.feature_name: r for r in training.leakage_audit(labels, history, datetime(2024, 6, 1)).collect()}
    assert audit["txn_count_7d"].asDict() == {
        "feature_name": "txn_count_7d", "n_labels": 3, "n_late": 1, "n_changed": 1, "mean_shift": 994.0
    }
    assert audit["open_tickets"].n_changed == 0


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    # A third of the rows share one score.
    rows = [(i, rng.randrange(2), 0.5 if i % 3 == 0 else rng.randrange(100) / 100) for i in range(240)]
    return rows, spark.createDataFrame(rows, SCORED).cache()


def test_auc(scored):
    rows, df = scored
    pos, neg = ([s for _, y, s in rows if y == c] for c in (1, 0))
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(q.auc(df).first().roc_auc - pairs / len(pos) / len(neg)) < 1e-12


def test_average_precision(scored):
    rows, df = scored
    total = sum(y for _, y, _ in rows)
    expected = 0.0
    for cut in sorted({s for _, _, s in rows}, reverse=True):
        shown = [y for _, y, s in rows if s >= cut]
        expected += sum(y for _, y, s in rows if s == cut) / total * sum(shown) / len(shown)
    assert abs(q.average_precision(df).first().average_precision - expected) < 1e-12


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_has_no_ranking(spark, label):
    df = spark.createDataFrame([(1, label, 0.3), (2, label, 0.8)], SCORED)
    assert q.auc(df).first().asDict() == {"roc_auc": None, "n_positive": 2 * label, "n_negative": 2 - 2 * label}
    assert q.average_precision(df).first().average_precision == (1.0 if label else None)
    nothing = df.limit(0)
    assert q.auc(nothing).first().roc_auc is None and q.average_precision(nothing).first().average_precision is None


def test_f1(spark, scored):
    rows, df = scored
    tp = sum(y for _, y, s in rows if s > 0.5)
    wrong = sum((s > 0.5) != (y == 1) for _, y, s in rows)
    assert abs(q.f1_score(df).first().f1 - 2 * tp / (2 * tp + wrong)) < 1e-12
    assert q.f1_score(spark.createDataFrame([(1, 0, 0.1)], SCORED)).first().f1 == 0.0


def test_split_and_weights(scored):
    rows, df = scored
    parts = q.stratified_split(df).collect()
    assert len(parts) == len(rows)
    for label in (0, 1):
        of_class = [r for r in parts if r.churned == label]
        assert sum(r.part == "test" for r in of_class) == len(of_class) // 5
    assert {(r.entity_id, r.part) for r in q.stratified_split(df).collect()} == {(r.entity_id, r.part) for r in parts}
    n = len(rows)
    for r in q.class_weights(df).collect():
        assert r.weight == n / (2 * sum(y == r.churned for _, y, _ in rows))


def test_model_learns(make_history):
    rng = random.Random(1)
    rows = [(i, NOW, {"days_since_last_txn": float(rng.randrange(90)), "open_tickets": float(rng.randrange(3))}) for i in range(1, 201)]
    labelled = make_history(rows).selectExpr("*", "int(days_since_last_txn > 45) AS churned")
    model = q.fit_churn_model(labelled, rounds=3, depth=2)
    assert q.auc(q.score_churn(model, labelled)).first().roc_auc > 0.95
    weights = q.feature_importances(model)
    assert max(weights, key=weights.get) == "days_since_last_txn"


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_split_takes_the_first_hashes_of_each_class(spark, share):
    rows = [(k // 2, k % 2) for k in range(90)] + [(7, 1)] * 40
    got = q.stratified_split(spark.createDataFrame(rows, "entity_id bigint, churned int"), share=share).collect()
    for label in (0, 1):
        mine = [r for r in got if r.churned == label]
        key = lambda r: hashlib.md5(f"{r.entity_id}-{q.SEED}".encode()).hexdigest()
        order = sorted(mine, key=key)
        limit = int(len(mine) * share)
        test = [r for r in order if sum(key(o) <= key(r) for o in order) <= limit]
        assert sorted(r.entity_id for r in mine if r.part == "test") == sorted(r.entity_id for r in test)


def test_split_keeps_null_ids_and_labels(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (3, None)], "entity_id bigint, churned int")
    assert q.stratified_split(labels).count() == 4


def test_latency_of_requests_without_path(spark):
    requests = spark.createDataFrame([(None, 1.0), ("/a", 2.0), (None, 3.0)], "path string, latency_ms double")
    assert {r.path for r in run_log.latency_percentiles(requests).collect()} == {None, "/a"}


def _folder(spark, path):
    """Order tables of four customers, one of them twice and one without orders."""
    time = "timestamp_ntz'1998-04-01' + make_dt_interval(k * 20)"
    frames = {
        "customer": spark.sql("SELECT explode(array(1, 2, 2, 3, 4)) AS k").selectExpr(
            "bigint(k) AS c_custkey", "'' AS c_name", "1 AS c_nationkey", "0D AS c_acctbal", "IF(k = 1, 'BUILDING', 'FURNITURE') AS c_mktsegment"),
        "orders": spark.sql("SELECT explode(sequence(0, 11)) AS k").selectExpr(
            "bigint(k) AS o_orderkey", "bigint(k % 3 + 1) AS o_custkey", "IF(k = 4, 'P', 'O') AS o_orderstatus", "k + 0.5D AS o_totalprice",
            f"IF(k % 3 = 2, timestamp_ntz'1996-01-01', {time}) AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": spark.sql("SELECT explode(sequence(0, 11)) AS k").selectExpr(
            "bigint(k) AS l_orderkey", "1L AS l_partkey", "1L AS l_suppkey", "1 AS l_linenumber", "1D AS l_quantity", "1D AS l_extendedprice",
            "0D AS l_discount", "0D AS l_tax", "IF(k % 2 = 0, 'R', 'N') AS l_returnflag", "'F' AS l_linestatus", f"{time} AS l_shipdate"),
    }
    for name, rows in frames.items():
        rows.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_history_for_training_is_made_for_labelled_users_only(spark, tmp_path):
    folder = _folder(spark, tmp_path)
    labels, history = training_queries._labelled(spark, folder)
    assert {r.entity_id for r in labels.collect()} == {r.entity_id for r in history.collect()} == {1, 2}  # 3 was silent, 4 never bought
    whole = fx.quarters(spark, folder).where("entity_id IN (1, 2)")
    assert history.count() == whole.count() and history.exceptAll(whole).count() == 0
    for made, want in (
        (training_queries.pit_training_set(spark, folder), training.pit_training_set(labels, fx.quarters(spark, folder))),
        (training_queries.naive_training_set(spark, folder), training.naive_training_set(labels, fx.quarters(spark, folder), training_queries.AS_OF)),
    ):
        assert made.count() == want.count() > 0 and made.exceptAll(want).count() == 0


def test_the_set_is_stored_before_it_is_split(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(q, "stage", lambda df, label: stored.append(label) or df)
    rows = spark.createDataFrame([(i, 0) for i in range(20)], "entity_id bigint, churned int")  # one class: not fitted
    assert q.score_models({"only": rows}).count() == 20
    assert stored == ["labelled", "split", "model-scores"]
