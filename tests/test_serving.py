import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from raw_data import NOW

from tidemark.operators import online
from tidemark.operators.retrieval import dual_path_batch, dual_path_summary, on_demand_batch, on_demand_single, parity_check
from tidemark.operators.features import feature_vector
from tidemark.session import new_path
from tidemark.sources import online_log
from tidemark.sources.online_log import delete_online, manifest, read_online, write_online
from tidemark.streaming import refresh
from tidemark.streaming.refresh import refresh_online

HOUR = timedelta(hours=1)


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "entity_id bigint")


def _table(make_history, *ids, at=NOW, written=NOW, **values):
    return online.as_online(make_history([(i, at, values) for i in ids]), written)


def test_round_trip_size_and_delete(spark, make_history):
    root = new_path(spark, "online")
    write_online(spark, root, online.upsert(read_online(spark, root), _table(make_history, 1, 2, 3)))
    found = {r.entity_id: (r.hit, r.txn_count_7d) for r in online.lookup(read_online(spark, root), _ids(spark, 1, 1, 999), NOW).collect()}
    assert found == {1: (True, 1.0), 999: (False, None)}
    assert online.size(read_online(spark, root), NOW).first().entities == 3
    delete_online(spark, root, _ids(spark, 2, 2, None))
    assert online.size(read_online(spark, root), NOW).first().entities == 2


def test_rows_expire_after_48_hours(spark, make_history):
    table = _table(make_history, 1)
    assert online.size(table, NOW + 48 * HOUR - timedelta(seconds=1)).first().entities == 1
    assert online.size(table, NOW + 48 * HOUR).first().entities == 0
    assert not online.lookup(table, _ids(spark, 1), NOW + 48 * HOUR).first().hit


def test_newest_event_time_wins_and_repeats_change_nothing(make_history):
    old, new = _table(make_history, 1, txn_count_7d=1.0), _table(make_history, 1, at=NOW + HOUR, txn_count_7d=2.0)
    for first, second in ((old, new), (new, old)):
        merged = online.upsert(first, second)
        assert [r.txn_count_7d for r in merged.collect()] == [2.0]
        assert online.upsert(merged, second).exceptAll(merged).count() == 0


def test_versions_are_kept_apart(spark, make_history):
    table = online.upsert(
        _table(make_history, 1, txn_count_7d=1.0), online.as_online(make_history([(1, NOW, {"txn_count_7d": 2.0})], "v2"), NOW)
    )
    assert online.lookup(table, _ids(spark, 1), NOW, "v2").first().txn_count_7d == 2.0
    assert not online.lookup(table, _ids(spark, 1), NOW, "v3").first().hit


def test_reads_degrade_and_writes_raise(spark, make_history):
    root = new_path(spark, "absent")
    assert online.size(read_online(spark, root), NOW).first().entities == 0
    assert not online.lookup(read_online(spark, root), _ids(spark, 1), NOW).first().hit
    with pytest.raises(Exception):
        write_online(spark, "nosuchscheme://nowhere/online", _table(make_history, 1))


def _ids_of(df):
    return sorted(r.entity_id for r in df.collect())


def _files(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


def test_a_write_that_is_not_committed_is_not_read(spark, make_history, monkeypatch):
    root = new_path(spark, "online")
    write_online(spark, root, _table(make_history, 1))
    with monkeypatch.context() as broken:
        broken.setattr(online_log, "rename_new", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            write_online(spark, root, _table(make_history, 2))
    assert _ids_of(read_online(spark, root)) == [1] and manifest(spark, root)["number"] == 0
    write_online(spark, root, _table(make_history, 3))
    assert _ids_of(read_online(spark, root)) == [1, 3]


def test_of_two_writers_the_first_wins(spark, make_history, monkeypatch):
    root = new_path(spark, "online")
    write_online(spark, root, _table(make_history, 1))
    begun = manifest(spark, root)
    write_online(spark, root, _table(make_history, 2))
    monkeypatch.setattr(online_log, "manifest", lambda *a: begun)  # the second started from the same manifest
    with pytest.raises(Exception, match="exist"):
        write_online(spark, root, _table(make_history, 3))
    monkeypatch.undo()
    assert _ids_of(read_online(spark, root)) == [1, 2]


def test_one_entity_writes_one_bucket_and_leaves_the_others(spark, make_history):
    root = new_path(spark, "online")
    write_online(spark, root, _table(make_history, *range(300)))
    before = _files(root)
    assert len({f.split("/")[2] for f in before}) == online_log.BUCKETS
    write_online(spark, root, _table(make_history, 7, at=NOW + HOUR, txn_count_7d=5.0))
    new = _files(root) - before
    assert before < _files(root) and len({f.split("/")[2] for f in new}) == 1
    assert {r.entity_id: r.txn_count_7d for r in read_online(spark, root).collect()} == {k: 5.0 if k == 7 else 1.0 for k in range(300)}
    plan = read_online(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # only the bucket with two folders is merged


def test_full_buckets_are_compacted_and_old_folders_go(spark, make_history):
    root = new_path(spark, "online")
    ids = list(range(40))
    write_online(spark, root, _table(make_history, *ids, txn_count_7d=0.0), folders=3)
    for k in range(1, 9):
        write_online(spark, root, _table(make_history, 7, 8, at=NOW + k * HOUR, txn_count_7d=float(k)), folders=3)
    want = {i: 8.0 if i in (7, 8) else 0.0 for i in ids}
    assert {r.entity_id: r.txn_count_7d for r in read_online(spark, root).collect()} == want
    state = manifest(spark, root)
    assert max(map(len, state["live"].values())) <= 3
    kept = [p.name for p in Path(root, "_manifest").glob("*.json")]
    assert len(kept) == online_log.KEEP
    buckets = {f.split("/")[2] for f in _files(root) if "bucket" in f}
    # per busy bucket at most what the kept manifests name; the others still have their first folder alone
    assert len({"/".join(f.split("/")[:3]) for f in _files(root)}) <= len(buckets) + 2 * 4
    delete_online(spark, root, _ids(spark, *ids), folders=1)
    assert read_online(spark, root).count() == 0 and not manifest(spark, root)["live"]


def test_a_deleted_entity_comes_back_with_a_later_write_even_of_an_older_time(spark, make_history):
    root = new_path(spark, "online")
    write_online(spark, root, _table(make_history, 1, 2))
    delete_online(spark, root, _ids(spark, 1))
    assert _ids_of(read_online(spark, root)) == [2]
    write_online(spark, root, _table(make_history, 1, at=NOW - HOUR))
    assert {r.entity_id: r.event_time for r in read_online(spark, root).collect()} == {1: NOW - HOUR, 2: NOW}


def test_random_writes_equal_plain_merging(spark, make_history):
    rng = random.Random(2)
    root, kept = new_path(spark, "online"), {}
    for _ in range(12):
        ids = rng.sample(range(12), 4)
        if rng.random() < 0.3:
            delete_online(spark, root, _ids(spark, *ids), folders=2)
            kept = {i: v for i, v in kept.items() if i not in ids}
        else:
            at, value = NOW + rng.randrange(5) * HOUR, float(rng.randrange(100))
            write_online(spark, root, _table(make_history, *ids, at=at, txn_count_7d=value), folders=2)
            for i in ids:
                kept[i] = max(kept.get(i, (at, value)), (at, value))
        assert {r.entity_id: (r.event_time, r.txn_count_7d) for r in read_online(spark, root).collect()} == kept


def test_on_demand(spark, windows_raw):
    rows = {r.entity_id: r for r in on_demand_batch(*windows_raw, _ids(spark, 1, 999), NOW).collect()}
    assert rows[1].txn_count_7d == 3.0 and rows[1].violations == []
    assert rows[999].txn_count_7d is None and rows[999].violations is None
    single = on_demand_single(*windows_raw, 1, NOW).first()
    assert single.total_spend_7d == 175.0
    assert on_demand_single(*windows_raw, 9999, NOW).count() == 0


def test_dual_path_mixed(spark, make_raw, make_history):
    raw = make_raw([(2, date(2024, 1, 1), "basic"), (3, date(2025, 1, 1), "pro")])
    answers = dual_path_batch(_table(make_history, 1, txn_count_7d=5.0), *raw, _ids(spark, 1, 2, 3, 9), NOW)
    found = {r.entity_id: (r.source, r.txn_count_7d, r.plan_encoded) for r in answers.collect()}
    assert found == {
        1: ("online_store", 5.0, 1.0), 2: ("on_demand", 0.0, 1.0), 3: ("invalid", None, None), 9: ("not_found", None, None)
    }
    assert dual_path_summary(answers).first().asDict() == {"hits": 1, "misses": 3, "on_demand_computed": 1}


def test_parity(windows_raw):
    features = feature_vector(*windows_raw, NOW)
    assert {r.n_different for r in parity_check(features, features).collect()} == {0}
    changed = features.selectExpr("* EXCEPT (open_tickets)", "open_tickets + 1 AS open_tickets")
    different = [r.feature_name for r in parity_check(features, changed).collect() if r.n_different]
    assert different == ["open_tickets"]


def test_run_summary(spark, make_history):
    entities = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")

    def summary(rows):
        return online.materialize_summary(entities, online.materialize_rows(make_history(rows), NOW)).first().asDict()

    bad = {"plan_encoded": 9.0}
    every = dict(total=3, failed=0)
    assert summary([(1, NOW, {})]) == every | dict(processed=1, validation_failures=0, skipped=2, status="success")
    assert summary([(1, NOW, {}), (2, NOW, bad)]) == every | dict(processed=1, validation_failures=1, skipped=1, status="partial")
    assert summary([(1, NOW, bad)]) == every | dict(processed=0, validation_failures=1, skipped=2, status="failed")


def test_stream_equals_batch_and_rests_without_new_files(spark, make_history):
    history, root, state = (new_path(spark, n) for n in ("history", "online", "state"))
    first = make_history([(1, NOW, {"txn_count_7d": 1.0}), (2, NOW, {}), (3, NOW, {"plan_encoded": 9.0})])
    second = make_history([(1, NOW + HOUR, {"txn_count_7d": 2.0}), (2, NOW - HOUR, {"txn_count_7d": 7.0})])
    at = datetime(2024, 6, 2)
    for part in (first, second):
        part.selectExpr("*", "event_time AS computed_at", "'s' AS snapshot_id").write.mode("append").partitionBy(
            "feature_version", "snapshot_id"
        ).parquet(history)
        refresh_online(spark, history, root, state, at)
    found = {r.entity_id: r.txn_count_7d for r in read_online(spark, root).collect()}
    assert found == {1: 2.0, 2: 1.0}
    whole = online.materialize_rows(first.unionByName(second), at).where("size(violations) = 0")
    assert online.as_online(whole, at).exceptAll(read_online(spark, root)).count() == 0
    before = read_online(spark, root).inputFiles()
    refresh_online(spark, history, root, state, at)
    assert read_online(spark, root).inputFiles() == before


def _arrive(spark, parts, as_ofs, **more):
    history, root, state = (new_path(spark, n) for n in ("history", "online", "state"))
    for part, as_of in zip(parts, as_ofs, strict=True):
        part.selectExpr("*", "event_time AS computed_at", "'s' AS snapshot_id").write.mode("append").partitionBy(
            "feature_version", "snapshot_id"
        ).parquet(history)
        refresh_online(spark, history, root, state, as_of, **more)
    return {r.entity_id: r.event_time for r in read_online(spark, root).collect()}


def test_stream_does_not_depend_on_batches(spark, make_history):
    old, bad = make_history([(1, NOW, {})]), make_history([(1, NOW + HOUR, {"plan_encoded": 9.0}), (2, NOW, {})])
    later = NOW + 2 * HOUR
    valid = {1: NOW, 2: NOW}  # the newest row of entity 1 breaks a rule, so the one before it stays
    assert _arrive(spark, [old, bad], [later, later]) == _arrive(spark, [bad, old], [later, later]) == valid
    assert _arrive(spark, [old.unionByName(bad)], [later]) == valid
    assert _arrive(spark, [old.unionByName(bad)], [later], max_files=1) == valid


def test_a_repeated_batch_changes_nothing(spark, make_history):
    root = new_path(spark, "online")
    assert write_online(spark, root, _table(make_history, 1), batch=("refresh", 0)) == 0
    assert write_online(spark, root, _table(make_history, 2), batch=("refresh", 0)) == 0
    assert write_online(spark, root, _table(make_history, 2), batch=("other", 0)) == 1
    assert _ids_of(read_online(spark, root)) == [1, 2]
    files = _files(root)
    write_online(spark, root, _table(make_history, 3), batch=("refresh", 0))
    assert _files(root) == files


def test_stream_keeps_rows_later_than_the_time_of_writing(spark, make_history):
    rows = make_history([(1, NOW, {}), (1, NOW + 3 * HOUR, {})])
    empty = rows.where("false")
    assert _arrive(spark, [rows, empty], [NOW + HOUR, NOW + 4 * HOUR]) == {1: NOW + 3 * HOUR}


def test_stream_reads_stored_files_instead_of_a_second_copy(spark, make_history, monkeypatch):
    written = []

    def write(spark, root, rows, batch):
        copies = [p.name for p in Path(root).parent.iterdir() if p.name.startswith("arrivals-")]
        written.append((rows.count(), copies))

    monkeypatch.setattr(refresh, "write_online", write)
    rows = make_history([(1, NOW, {}), (2, NOW, {"plan_encoded": 9.0})])
    history, root, state = (new_path(spark, n) for n in ("history", "online", "state"))
    rows.selectExpr("*", "event_time AS computed_at", "'s' AS snapshot_id").write.partitionBy("feature_version", "snapshot_id").parquet(history)
    refresh_online(spark, history, root, state, NOW)
    assert written == [(1, [])]
    (bad,) = spark.read.parquet(f"{root}_quarantine/batch=000000000000").collect()
    assert (bad.entity_id, bad.violations, bad.run_id) == (2, ["plan_encoded:known_code"], "refresh-0")
