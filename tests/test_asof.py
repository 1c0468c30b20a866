import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators.asof import latest_asof, latest_for_ids, pit_join
from tidemark.schemas import FEATURE_HISTORY
from tidemark.session import new_path
from tidemark.sources.tables import append_history, read

LABELS = "entity_id bigint, label_time timestamp_ntz, tag string"
JAN, FEB, MAR, APR = (datetime(2024, m, 1) for m in (1, 2, 3, 4))


def _history(make_history):
    return make_history([
        (1, JAN, {"txn_count_7d": 5.0}), (1, MAR, {"txn_count_7d": 999.0}), (2, JAN, {"txn_count_7d": 777.0})
    ])


def _values(df):
    return sorted(((r.entity_id, r.tag, r.txn_count_7d) for r in df.collect()), key=str)


def test_never_sees_the_future(spark, make_history):
    labels = spark.createDataFrame([(1, FEB, "a"), (2, FEB, "b"), (1, APR, "c")], LABELS)
    assert _values(pit_join(labels, _history(make_history))) == [(1, "a", 5.0), (1, "c", 999.0), (2, "b", 777.0)]


def test_edges(spark, make_history):
    history = make_history([(1, JAN, {"txn_count_7d": None}), (1, MAR, {"txn_count_7d": 9.0})])
    labels = spark.createDataFrame(
        [
            (1, MAR, "same moment"), (1, JAN - timedelta(microseconds=1), "before any"), (1, FEB, "matched null"),
            (3, FEB, "unknown"), (1, FEB, "matched null"), (None, FEB, "no id"), (1, None, "no time"),
        ],
        LABELS,
    )
    rows = pit_join(labels, history).collect()
    assert len(rows) == 7
    found = {r.tag: (r.txn_count_7d, r.feature_time) for r in rows}
    assert found["same moment"] == (9.0, MAR)
    assert found["before any"] == (None, None)
    assert found["matched null"] == (None, JAN)
    assert found["unknown"] == (None, None) and found["no id"] == (None, None) and found["no time"] == (None, None)


def test_versions_do_not_mix(spark, make_history):
    both = _history(make_history).unionByName(make_history([(1, FEB, {"txn_count_7d": -1.0})], "v2"))
    labels = spark.createDataFrame([(1, FEB, "a")], LABELS)
    assert _values(pit_join(labels, both)) == [(1, "a", 5.0)]
    assert _values(pit_join(labels, both, "v2")) == [(1, "a", -1.0)]
    assert _values(pit_join(labels, both, "v3")) == [(1, "a", None)]


def test_empty_labels(spark, make_history):
    assert pit_join(spark.createDataFrame([], LABELS), _history(make_history)).count() == 0


@pytest.mark.parametrize("slot_days", [1, 3, 30, 4000])
def test_busy_entities_give_the_same_rows(spark, make_history, slot_days):
    """Entity 1 holds a third of the rows, and one of its labels is copied many times."""
    rng = random.Random(7)
    who = lambda: rng.choice([1, 1, 1, 2, 3, 4, 5, 6])
    known = {}
    while len(known) < 120:
        known[(who(), JAN + timedelta(hours=rng.randrange(2000)))] = float(rng.randrange(1000))
    labels = [(who(), JAN + timedelta(hours=rng.randrange(-50, 2100)), str(i)) for i in range(150)]
    labels += [(1, MAR, "copy")] * 70 + [(1, None, "no time"), (None, MAR, "no id"), (9, MAR, "unknown")]
    expected = []
    for entity, at, tag in labels:
        times = [t for e, t in known if e == entity and at is not None and t <= at]
        expected.append((entity, tag, known[(entity, max(times))] if times else None))
    history = make_history([(e, t, {"txn_count_7d": v}) for (e, t), v in known.items()])
    joined = pit_join(spark.createDataFrame(labels, LABELS), history, slot_days=slot_days)
    assert _values(joined) == sorted(expected, key=str)


def test_latest(spark, make_history):
    history = _history(make_history)
    early = {r.entity_id: r.txn_count_7d for r in latest_asof(history, FEB).collect()}
    late = {r.entity_id: r.txn_count_7d for r in latest_asof(history, APR).collect()}
    assert early == {1: 5.0, 2: 777.0} and late == {1: 999.0, 2: 777.0}
    ids = spark.createDataFrame([(1,), (1,), (42,)], "entity_id bigint")
    assert [(r.entity_id, r.txn_count_7d) for r in latest_for_ids(history, ids, FEB).collect()] == [(1, 5.0)]


def test_latest_keeps_one_row_per_task_before_the_shuffle(make_history):
    plan = latest_asof(_history(make_history), APR)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_slots_before_1970_and_copies_of_a_row(spark, make_history):
    early = datetime(1969, 12, 20)
    history = make_history([(1, early, {"txn_count_7d": 1.0}), (1, JAN, {"txn_count_7d": 4.0}), (1, JAN, {"txn_count_7d": 6.0})])
    labels = spark.createDataFrame(
        [(1, early - timedelta(days=1), "a"), (1, datetime(1970, 2, 1), "b"), (1, JAN, "c")], LABELS
    )
    assert _values(pit_join(labels, history)) == [(1, "a", None), (1, "b", 1.0), (1, "c", 6.0)]


def _jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_join_is_lazy_and_reads_history_once(spark, make_history):
    path = new_path(spark, "history")
    append_history(path, _history(make_history), JAN)
    stored = read(spark, path, FEATURE_HISTORY)
    labels = spark.createDataFrame([(1, FEB, "a"), (2, FEB, "b")], LABELS)
    joined, jobs = _jobs_of(spark, "lazy", lambda: pit_join(labels, stored))
    assert jobs == 0
    rows = joined.collect()
    assert {r.tag: r.txn_count_7d for r in rows} == {"a": 5.0, "b": 777.0}
    plan = joined._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and "ReusedExchange" in plan
    # the folder of March is later than every label, so only that of January is read
    assert "snapshot_id" in scans[0].split("PartitionFilters")[1]
    files = spark.createDataFrame([(1, JAN, "a")], LABELS)
    assert {r.feature_time for r in pit_join(files, stored).collect()} == {JAN}
