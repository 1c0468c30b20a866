from datetime import date, datetime, timedelta

from raw_data import NOW

from tidemark.operators.backfill import history_on_grid
from tidemark.operators.features import feature_vector

DAY = timedelta(days=1)
SIGNUP = date(2024, 1, 1)


def _one(raw, at=NOW):
    rows = feature_vector(*raw, at).collect()
    assert len(rows) == 1
    return rows[0]


def test_windows(windows_raw):
    row = _one(windows_raw)
    assert (row.txn_count_7d, row.txn_count_30d, row.txn_count_90d) == (3.0, 3.0, 3.0)
    assert (row.total_spend_7d, row.total_spend_30d, row.avg_txn_amount_30d) == (175.0, 175.0, 175.0 / 3)
    assert row.failed_txn_rate_30d == 0.25
    assert row.plan_encoded == 2.0
    assert row.days_since_last_txn == 1.0
    assert row.account_age_days == 152.0


def test_never_transacted(make_raw):
    row = _one(make_raw([(2, SIGNUP, "free")]))
    assert row.days_since_last_txn == 9999.0
    assert row.failed_txn_rate_30d == 0.0 and row.avg_txn_amount_30d == 0.0


def test_window_edges(make_raw):
    raw = make_raw(
        [(1, SIGNUP, "basic")],
        [
            (1, 1, "success", NOW),
            (1, 2, "success", NOW - 7 * DAY),
            (1, 4, "success", NOW - 7 * DAY - timedelta(microseconds=1)),
        ],
        [(1, 0, NOW), (1, 0, NOW - 30 * DAY), (1, 0, NOW - 31 * DAY)],
    )
    row = _one(raw)
    assert (row.total_spend_7d, row.total_spend_30d) == (2.0, 6.0)
    assert (row.open_tickets, row.ticket_rate_30d) == (2.0, 1.0)


def test_recency_counts_midnights(make_raw):
    at = datetime(2024, 6, 1, 0, 1)
    raw = make_raw([(1, SIGNUP, "basic")], [(1, 1, "success", datetime(2024, 5, 31, 23, 59))])
    assert _one(raw, at).days_since_last_txn == 1.0


def test_missing_or_unknown_plan_and_late_signup(make_raw):
    raw = make_raw([(1, SIGNUP, None), (2, date(2024, 7, 1), "gold"), (3, SIGNUP, "free"), (4, None, "enterprise")])
    rows = {r.entity_id: r for r in feature_vector(*raw, NOW).collect()}
    assert [rows[i].plan_encoded for i in (1, 2, 3, 4)] == [3.0, 3.0, 0.0, 3.0]
    assert rows[2].account_age_days == -30.0
    assert rows[4].account_age_days is None


def test_rows_of_one_fact_do_not_multiply_the_other(make_raw):
    raw = make_raw(
        [(1, SIGNUP, "pro")],
        [(1, 10, "success", NOW - i * DAY) for i in range(1, 6)],
        [(1, i % 2, NOW - i * DAY) for i in range(1, 5)],
    )
    row = _one(raw)
    assert (row.txn_count_30d, row.total_spend_30d, row.open_tickets, row.ticket_rate_30d) == (5.0, 50.0, 2.0, 4.0)


def test_session_time_zone_does_not_matter(spark, windows_raw):
    expected = _one(windows_raw)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert _one(windows_raw) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_spend_keeps_fractions_and_marks_odd_amounts(make_raw):
    at, day = NOW - timedelta(days=1), NOW.date()
    users = [(u, day, "pro") for u in (1, 2, 3, 4)]
    facts = [(1, 0.004, "success", at)] * 1000 + [(2, float("nan"), "success", at), (3, 1e17, "success", at), (3, 0.25, "success", at)]
    raw = make_raw(users, facts + [(4, float("inf"), "failed", at)])
    for found in (feature_vector(*raw, NOW), history_on_grid(*raw, NOW, 0, 24)):
        spend = {r.entity_id: r.total_spend_7d for r in found.collect()}
        assert spend[1] == 4.0 and spend[2] != spend[2] and spend[3] == 1e17 and spend[4] == 0.0
