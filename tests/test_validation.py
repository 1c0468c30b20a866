import pytest
from raw_data import NOW

from tidemark.operators.validation import clean, quarantined_rows, valid_rows, validate, violation_counts

BASE = {"failed_txn_rate_30d": 0.05, "plan_encoded": 1.0, "days_since_last_txn": 2.0, "account_age_days": 365.0}


def _rows(make_history, *changes, entity=1):
    return make_history([(entity, NOW, BASE | c) for c in changes])


def _broken(df):
    return [v for r in validate(df).collect() for v in r.violations]


def test_valid_rows_pass(make_history):
    assert _broken(_rows(make_history, {}, {"txn_count_7d": 5.0})) == []


@pytest.mark.parametrize("value", [float("nan"), None])
def test_missing_becomes_zero(make_history, value):
    df = _rows(make_history, {"txn_count_7d": value, "avg_txn_amount_30d": value})
    row = valid_rows(df).first()
    assert row.txn_count_7d == 0.0 and row.avg_txn_amount_30d == 0.0


@pytest.mark.parametrize("rate,cleaned", [(1.0001, 1.0), (1.01, 1.0), (-0.2, 0.0), (0.5, 0.5), (1.5, 1.5)])
def test_rate_noise(make_history, rate, cleaned):
    assert clean(_rows(make_history, {"failed_txn_rate_30d": rate})).first().failed_txn_rate_30d == cleaned


@pytest.mark.parametrize(
    "change,rule",
    [
        ({"txn_count_7d": -1.0}, "txn_count_7d:at_least_0"),
        ({"failed_txn_rate_30d": 1.5}, "failed_txn_rate_30d:at_most_1"),
        ({"plan_encoded": 5.0}, "plan_encoded:known_code"),
        ({"plan_encoded": 1.5}, "plan_encoded:known_code"),
        ({"account_age_days": -3.0}, "account_age_days:at_least_0"),
    ],
)
def test_broken_rules(make_history, change, rule):
    assert _broken(_rows(make_history, change)) == [rule]


def test_ids_start_at_one(make_history):
    assert _broken(_rows(make_history, {}, entity=0)) == ["entity_id:at_least_1"]
    assert _broken(_rows(make_history, {}, entity=None)) == ["entity_id:not_null"]


def test_all_violations_are_reported(make_history):
    df = _rows(make_history, {"txn_count_7d": -1.0, "plan_encoded": 5.0}, {"txn_count_7d": -2.0}, {})
    counts = {(r["column"], r.rule): r.n_rows for r in violation_counts(df).collect()}
    assert counts == {("txn_count_7d", "at_least_0"): 2, ("plan_encoded", "known_code"): 1}


def test_text_is_coerced_or_fails(make_history):
    df = _rows(make_history, {}).selectExpr("* EXCEPT (txn_count_7d)", "'3.5' AS txn_count_7d")
    assert valid_rows(df).first().txn_count_7d == 3.5
    bad = _rows(make_history, {}).selectExpr("* EXCEPT (txn_count_7d)", "'many' AS txn_count_7d")
    assert _broken(bad) == ["txn_count_7d:not_null"]


def test_extra_columns_stay_and_no_row_is_lost(make_history):
    df = _rows(make_history, {}, {"plan_encoded": 7.0}).selectExpr("*", "'x' AS `extra column`")
    assert valid_rows(df).count() + quarantined_rows(df).count() == 2
    assert valid_rows(df).first()["extra column"] == "x"
