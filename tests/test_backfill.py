import random
from datetime import date, datetime, timedelta

import pytest
from raw_data import NOW

from pyspark.sql import functions as F

from tidemark.functions.columns import moment
from tidemark.operators.backfill import backfill_history, backfill_plan, backfill_split, pending_snapshots, spine_from, spine_start
from tidemark.operators.features import feature_vector


def _random_raw(make_raw, seed):
    rng = random.Random(seed)
    start = NOW - timedelta(days=140)

    def moment_():
        base = start + timedelta(seconds=rng.randrange(150 * 86_400), microseconds=rng.randrange(1_000_000))
        # Many events sit exactly on the hour or day, where windows open and close.
        return rng.choice([base, base.replace(minute=0, second=0, microsecond=0), datetime(base.year, base.month, base.day)])

    users = [(u, date(2024, 1, rng.randrange(1, 29)), rng.choice(["free", "basic", "pro", None])) for u in range(1, 9)]
    # User 1 has a third of all rows; ids 9 and 10 belong to no user.
    who = lambda: rng.choice([1, 1, 1, *range(2, 11)])
    transactions = [
        (who(), rng.randrange(1, 100_000) / 100, rng.choice(["success", "success", "failed", "refunded"]), moment_())
        for _ in range(400)
    ]
    tickets = [(who(), rng.randrange(2), moment_()) for _ in range(150)]
    return make_raw(users, transactions, tickets)


@pytest.mark.parametrize("days,hours", [(6, 24), (9, 36), (2, 7)])
def test_grid_equals_single_snapshots(make_raw, days, hours):
    raw = [df.cache() for df in _random_raw(make_raw, hours)]
    grid = backfill_history(*raw, NOW, days, hours).cache()
    assert grid.select("event_time").distinct().count() == days * 24 // hours + 1
    at = spine_start(NOW, days, hours)
    while at <= NOW:
        single = feature_vector(*raw, at)
        stored = grid.where(F.col("event_time") == moment(at))
        assert stored.count() == 8
        assert stored.exceptAll(single).count() == 0
        at += timedelta(hours=hours)


def test_copies_of_a_user_keep_their_own_counts(make_raw):
    raw = make_raw([(1, None, "pro"), (1, None, "pro")], [(1, 5, "success", NOW - timedelta(hours=1))])
    rows = backfill_history(*raw, NOW, 1, 24).where(F.col("event_time") == moment(NOW)).collect()
    assert [r.txn_count_7d for r in rows] == [1.0, 1.0]


def test_spine_has_both_ends_and_keeps_aligned_with_now(spark):
    now = spark.range(1).select(moment(datetime(2024, 6, 1, 5, 30)).alias("now"))
    times = [r.event_time for r in spine_from(now, "now", 90, 24).orderBy("event_time").collect()]
    assert len(times) == 91
    assert times[-1] == datetime(2024, 6, 1, 5) and times[0] == times[-1] - timedelta(days=90)
    odd = [r.event_time for r in spine_from(now, "now", 2, 7).orderBy("event_time").collect()]
    assert odd[-1] == times[-1] and len(odd) == 7 and odd[0] == odd[-1] - timedelta(hours=42)


def test_plan_and_pending(spark, make_history):
    spine = spark.createDataFrame([(NOW - timedelta(days=i),) for i in range(3)], "event_time timestamp_ntz")
    history = make_history([(1, NOW, {}), (2, NOW, {}), (1, NOW - timedelta(days=1), {})])
    plan = {r.event_time: (r.stored_rows, r.state) for r in backfill_plan(spine, history, expected_rows=2).collect()}
    assert plan == {
        NOW: (2, "stored"), NOW - timedelta(days=1): (1, "partial"), NOW - timedelta(days=2): (0, "pending")
    }
    assert [r.event_time for r in pending_snapshots(spine, history).collect()] == [NOW - timedelta(days=2)]
    assert pending_snapshots(spine, history, "v2").count() == 3


def test_rejects_a_grid_without_step(make_raw):
    with pytest.raises(ValueError):
        backfill_history(*make_raw(), NOW, 1, 0)


@pytest.mark.parametrize("after_first", [0, 1, 3, 5.5])
def test_a_split_history_has_the_rows_of_the_whole(make_raw, after_first):
    raw = [df.cache() for df in _random_raw(make_raw, 5)]
    whole = backfill_history(*raw, NOW, 6, 24).cache()
    at = spine_start(NOW, 6, 24) + timedelta(days=after_first)
    parts = backfill_split(*raw, at, NOW, 6, 24)
    for part, rows in zip(parts, (whole.where(F.col("event_time") <= moment(at)), whole.where(F.col("event_time") > moment(at))), strict=True):
        assert part.count() == rows.count() > 0
        assert part.exceptAll(rows).count() == 0
    with pytest.raises(ValueError):
        backfill_split(*raw, NOW, NOW, 6, 24)
