from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest
from raw_data import NOW

from pyspark.sql import functions as F

from tidemark.operators import backfill
from tidemark.operators.asof import latest_asof
from tidemark.operators.distribution import window_rows
from tidemark.schemas import FEATURE_HISTORY, RAW_SUPPORT_TICKETS, RAW_TRANSACTIONS, RAW_USERS
from tidemark.session import new_path
from tidemark.sources import online_log, tables
from tidemark.store import FeatureStore

DAY = timedelta(days=1)


def test_whole_life_of_a_store(spark, make_raw):
    users = [(0, date(2024, 1, 1), "pro")] + [(i, date(2024, 1, 1), "basic") for i in range(1, 7)]
    users.append(users[-1])  # A copied user must not copy features.
    transactions = [(i, 10 * i, "success", NOW - (i + j) * DAY) for i in range(1, 6) for j in range(6)]
    transactions += [(1, 3, "success", NOW - 29 * DAY), (2, 3, "failed", NOW - 3 * DAY)]
    raw = make_raw(users, transactions, [(1, 0, NOW - DAY), (2, 1, NOW - 2 * DAY)])
    store = FeatureStore(spark, new_path(spark, "store"))

    counts = {r.table_name: r.n_rows for r in store.load_raw(*raw).collect()}
    assert counts == {"raw_users": 8, "raw_transactions": 32, "raw_support_tickets": 2}
    assert [r.user_id for r in store.entity_ids().collect()] == [0, 1, 2, 3, 4, 5, 6]

    # History: one snapshot, then the rest of the grid; stored rows stay as they are.
    assert store.compute_features(NOW).first().n_rows == 7
    assert store.compute_features(NOW).first().n_rows == 7
    plan = store.run_backfill(NOW, days=4, dry_run=True)
    assert {(r.event_time, r.state) for r in plan.collect()} == {(NOW - i * DAY, "pending" if i else "stored") for i in range(5)}
    assert store.table("feature_history").count() == 7
    store.run_backfill(NOW, days=4)
    assert store.table("feature_history").count() == 35
    assert store.run_backfill(NOW, days=4).where("state <> 'stored'").isEmpty()
    assert store.table("feature_history").count() == 35
    assert store.recent_runs().count() == 4

    # Online: user 0 breaks the id rule, so the run is partial.
    summary = store.run_materialization(NOW)
    assert (summary["status"], summary["total"], summary["processed"], summary["validation_failures"]) == ("partial", 7, 6, 1)
    assert [r.entity_id for r in spark.read.parquet(store.path("quarantine")).collect()] == [0]
    ids = spark.createDataFrame([(1,), (6,), (77,)], "entity_id bigint")
    found = {r.entity_id: (r.hit, r.txn_count_30d) for r in store.online_features(ids, NOW).collect()}
    assert found == {1: (True, 7.0), 6: (True, 0.0), 77: (False, None)}
    assert store.online_size(NOW).first().entities == 6
    store.delete_online(spark.createDataFrame([(1,)], "entity_id bigint"))
    sources = {r.entity_id: (r.source, r.txn_count_30d) for r in store.features_for(ids, NOW).collect()}
    assert sources == {1: ("on_demand", 7.0), 6: ("online_store", 0.0), 77: ("not_found", None)}
    store.refresh_online(NOW)

    # Training and drift.
    labels = spark.createDataFrame([(1, NOW - 2 * DAY), (2, NOW - 30 * DAY)], "entity_id bigint, label_time timestamp_ntz")
    got = {r.entity_id: r.feature_time for r in store.training_dataset(labels).collect()}
    assert got == {1: NOW - 2 * DAY, 2: None}
    assert store.latest_features(ids, NOW).count() == 2
    assert store.feature_stats(NOW).count() == 13
    store.snapshot_training_distribution(NOW - 2 * DAY)
    report = store.skew_report(NOW, trained_at=NOW - 2 * DAY)
    assert report.count() == 13
    contexts = store.table("skew_snapshots").groupBy("context").count().collect()
    assert {(r["context"], r["count"]) for r in contexts} == {("training", 13), ("serving", 13)}
    churn = store.churn_labels(NOW + 30 * DAY)
    assert {r.entity_id: r.churned for r in churn.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    assert store.pit_training_set(churn).where(F.col("txn_count_30d") > 0).count() == 5
    assert store.leakage_audit(churn, NOW).count() == 13

    # Registry and logs.
    for _ in range(2):
        store.sync_registry(NOW)
    assert store.registry().count() == 13 and store.lineage().count() == 22
    assert store.lineage_for("plan_encoded").count() == 2
    store.log_requests(spark.createDataFrame([("batch", 2.0, True, NOW)], "path string, latency_ms double, hit boolean, ts timestamp_ntz"))
    assert store.latency().first().p99 == 2.0 and store.cache_hit_rate().first().cache_hit_rate == 1.0


def test_a_late_user_is_added_to_stored_snapshots(spark, make_raw):
    store = FeatureStore(spark, new_path(spark, "store"))
    store.load_raw(*make_raw([(1, date(2024, 1, 1), "pro")]))
    store.run_backfill(NOW, days=1)
    store.load_raw(*make_raw([(1, date(2024, 1, 1), "free"), (2, date(2024, 1, 1), "free")]))
    assert {r.state for r in store.run_backfill(NOW, days=1).collect()} == {"partial"}
    rows = store.table("feature_history").select("entity_id", "plan_encoded").distinct().collect()
    assert {(r.entity_id, r.plan_encoded) for r in rows} == {(1, 2.0), (2, 0.0)}


def test_only_snapshots_that_are_someones_newest_are_read(spark, make_history):
    times = [NOW - i * DAY for i in range(4)]
    history = make_history([(1, times[0], {}), (1, times[1], {}), (2, times[1], {}), (2, times[2], {}), (3, times[3], {})])
    path = new_path(spark, "history")
    tables.append_history(path, history, NOW)
    stored = tables.read(spark, path, FEATURE_HISTORY)
    for at, expected in ((NOW, {times[0], times[1], times[3]}), (times[1], {times[1], times[3]})):
        kept = tables.only_latest_snapshots(stored, at)
        assert {r.event_time for r in kept.collect()} == expected
        assert latest_asof(kept, at).exceptAll(latest_asof(stored, at)).isEmpty()
        assert latest_asof(kept, at).count() == 3
    assert tables.only_latest_snapshots(stored, NOW).columns == stored.columns
    assert "dynamicpruning" in _plan(tables.only_latest_snapshots(stored, NOW))
    assert tables.only_latest_snapshots(stored, NOW - 9 * DAY).isEmpty()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_folders_prune_every_reader_of_stored_history(spark, make_raw):
    store = FeatureStore(spark, new_path(spark, "store"))
    store.load_raw(*make_raw([(1, date(2024, 1, 1), "pro")]))
    store.run_backfill(NOW, days=3)
    history = store.table("feature_history")
    labels = spark.createDataFrame([(1, NOW - 2 * DAY)], "entity_id bigint, label_time timestamp_ntz")
    upper, lower = tables.snapshot_name(NOW - 2 * DAY), tables.snapshot_name(NOW - 3 * DAY)
    for read, bounds in (
        (window_rows(history, NOW - 2 * DAY, 1), (upper, lower)),
        (store.latest_features(labels.select("entity_id"), NOW - 2 * DAY), (upper,)),
        (store.training_dataset(labels), ("snapshot_id#", "<= Subquery")),  # the bound is the newest label, found as the plan runs
    ):
        filters = [line for line in _formatted(read).splitlines() if "PartitionFilters" in line]
        assert filters and all(b in line for b in bounds for line in filters if "snapshot_id" in line)
        assert any("snapshot_id" in line for line in filters)


def _formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_the_report_takes_the_logged_training_window(spark, make_raw):
    store = FeatureStore(spark, new_path(spark, "store"))
    store.load_raw(*make_raw([(i, date(2024, 1, 1), "pro") for i in range(1, 4)]))
    store.run_backfill(NOW, days=4)
    with pytest.raises(ValueError):
        store.skew_report(NOW)
    store.snapshot_training_distribution(NOW - 2 * DAY)
    logged = store.skew_report(NOW).collect()
    assert len(logged) == 13 and logged == store.skew_report(NOW, trained_at=NOW - 2 * DAY).collect()


def test_a_failed_materialization_is_logged(spark, make_raw, monkeypatch):
    store = FeatureStore(spark, new_path(spark, "store"))
    store.load_raw(*make_raw([(1, date(2024, 1, 1), "pro")]))
    store.compute_features(NOW)

    def broken(*_, **__):
        raise OSError("disk gone")

    monkeypatch.setattr(online_log, "write_online", broken)
    with pytest.raises(OSError):
        store.run_materialization(NOW)
    run = store.recent_runs().where("status = 'failed'").first()
    assert "disk gone" in run.error_message and (run.entities_processed, run.entities_failed) == (0, 1)
    assert not tables.list_names(spark, store.path("checked_features"))


def test_quarantined_rows_tell_their_run(spark, make_raw):
    store = FeatureStore(spark, new_path(spark, "store"))
    store.load_raw(*make_raw([(0, date(2024, 1, 1), "pro"), (1, date(2024, 1, 1), "pro")]))
    store.compute_features(NOW)
    runs = [store.run_materialization(at)["run_id"] for at in (NOW, NOW + DAY)]
    rows = spark.read.parquet(store.path("quarantine")).collect()
    assert {(r.entity_id, r.run_id, r.quarantined_at) for r in rows} == {(0, runs[0], NOW), (0, runs[1], NOW + DAY)}


def test_only_missing_snapshots_are_computed(spark, make_raw):
    raw = make_raw([(i, date(2024, 1, 1), "pro") for i in (1, 2)], [(1, 5, "success", NOW - 2 * DAY)], [(2, 0, NOW - 3 * DAY)])
    whole = backfill.backfill_history(*raw, NOW, days=4)
    ends = [NOW - 4 * DAY, NOW]
    some = backfill.history_on_grid(*raw, NOW - 4 * DAY, 4, 24, only=ends)
    assert {r.event_time for r in some.collect()} == set(ends)
    assert some.exceptAll(whole).isEmpty() and some.count() == 4


def test_the_newest_copy_of_a_user_counts(spark):
    store = FeatureStore(spark, new_path(spark, "store"))
    users = [(1, date(2024, 1, 1), "xx", plan, "a", NOW - i * DAY) for i, plan in ((9, "free"), (3, "pro"), (5, "basic"))]
    store.load_raw(
        spark.createDataFrame(users, RAW_USERS), spark.createDataFrame([], RAW_TRANSACTIONS),
        spark.createDataFrame([], RAW_SUPPORT_TICKETS),
    )
    store.compute_features(NOW)
    assert [r.plan_encoded for r in store.table("feature_history").collect()] == [2.0]


def _values(spark, path):
    return sorted((r.entity_id, r.event_time, r.txn_count_7d) for r in tables.read(spark, path, FEATURE_HISTORY).collect())


def test_two_writers_of_a_snapshot_store_each_key_once(spark, make_history, monkeypatch):
    """The second writer commits while the first is about to: both have found nothing stored."""
    path = new_path(spark, "history")
    first = make_history([(i, NOW, {"txn_count_7d": 1.0}) for i in (1, 2, 3)] + [(1, NOW - DAY, {"txn_count_7d": 1.0})])
    second = make_history([(i, NOW, {"txn_count_7d": 2.0}) for i in (2, 3, 4)])
    rename, calls = tables.rename_new, []

    def late(*args):
        calls.append(args)
        if len(calls) == 1:
            tables.append_history(path, second, NOW)
        return rename(*args)

    monkeypatch.setattr(tables, "rename_new", late)
    tables.append_history(path, first, NOW)
    assert _values(spark, path) == [(1, NOW - DAY, 1.0), (1, NOW, 1.0), (2, NOW, 2.0), (3, NOW, 2.0), (4, NOW, 2.0)]
    assert not tables.list_names(spark, f"{path}/_runs") and not tables.list_names(spark, f"{path}/_locks")


def test_writers_in_two_threads(spark, make_history):
    path = new_path(spark, "history")
    frames = [make_history([(i, NOW - (i % 3) * DAY, {"txn_count_7d": float(k)}) for i in range(k, k + 12)]) for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda f: tables.append_history(path, f, NOW), frames))
    keys = [(e, t) for e, t, _ in _values(spark, path)]
    assert len(keys) == len(set(keys)) == 15


def test_a_writer_waits_for_a_lock_and_then_gives_up(spark, make_history, monkeypatch):
    path = new_path(spark, "history")
    tables.append_history(path, make_history([(1, NOW, {})]), NOW)
    lock = f"{path}/_locks/feature_version=v1-snapshot_id={tables.snapshot_name(NOW)}"
    tables.write_text(spark, lock, "someone")
    monkeypatch.setattr(tables, "LOCK_TRIES", 2)
    monkeypatch.setattr(tables, "LOCK_WAIT", 0.01)
    with pytest.raises(RuntimeError, match="another writer"):
        tables.append_history(path, make_history([(2, NOW, {})]), NOW)
    tables.delete_path(spark, lock)
    tables.append_history(path, make_history([(2, NOW, {}), (1, NOW, {"txn_count_7d": 9.0})]), NOW)
    assert [(e, v) for e, _, v in _values(spark, path)] == [(1, 1.0), (2, 1.0)]


def test_copies_of_a_key_keep_the_largest_values(spark, make_history):
    path = new_path(spark, "history")
    tables.append_history(path, make_history([(1, NOW, {"txn_count_7d": v}) for v in (3.0, 8.0, 5.0)]), NOW)
    assert _values(spark, path) == [(1, NOW, 8.0)]
