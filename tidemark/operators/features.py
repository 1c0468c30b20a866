"""The one definition of the features as of a snapshot time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    before,
    days_crossed_sql,
    guarded_ratio_sql,
    in_window_sql,
    moment_sql,
    money_sql,
    odd_money_sql,
    plan_code_sql,
)
from tidemark.schemas import ENTITY_TYPE, FEATURES, NEVER_TRANSACTED, VERSION, WINDOW_DAYS

# Per-user measures from which every feature follows. The single-snapshot plan and the backfill
# plan reach these in different ways and share `from_measures`.
COUNTS = [f"n_ok_{n}" for n in WINDOW_DAYS]
SPEND = [f"money_{n}" for n in WINDOW_DAYS]
# Amounts that have no decimal value: with any of them the sum of a window is not a number.
ODD = [f"odd_{n}" for n in WINDOW_DAYS]
SUMS = [*COUNTS, *SPEND, *ODD, "n_failed_30", "n_all_30", "n_open", "n_tickets_30"]

SUCCESS = "status = 'success'"
FAILED = "status = 'failed'"
MONEY, ODD_MONEY = money_sql("amount"), odd_money_sql("amount")


def _measured(facts: DataFrame, snapshot: datetime, measures: dict[str, str]) -> DataFrame:
    """One row per user with any fact before the snapshot.

    The measures are sums, counts and maxima, so each task sends one row per user to the shuffle
    however many rows a user has.
    """
    columns = [F.expr(text).alias(name) for name, text in measures.items()]
    return facts.where(before("event_time", snapshot)).groupBy("user_id").agg(*columns)


def transaction_measures(transactions: DataFrame, snapshot: datetime) -> DataFrame:
    measures = {}
    for n in WINDOW_DAYS:
        inside = f"{SUCCESS} AND {in_window_sql('event_time', snapshot, n)}"
        measures[f"n_ok_{n}"] = f"count_if({inside})"
        measures[f"money_{n}"] = f"sum(CASE WHEN {inside} THEN {MONEY} END)"
        measures[f"odd_{n}"] = f"count_if({inside} AND {ODD_MONEY})"
    month = in_window_sql("event_time", snapshot, 30)
    measures["n_failed_30"] = f"count_if({FAILED} AND {month})"
    measures["n_all_30"] = f"count_if({month})"
    measures["last_ok"] = f"max(CASE WHEN {SUCCESS} THEN event_time END)"
    return _measured(transactions, snapshot, measures)


def ticket_measures(tickets: DataFrame, snapshot: datetime) -> DataFrame:
    """Open tickets use the resolved flag as it stands: the table keeps no time of resolution."""
    month = in_window_sql("event_time", snapshot, 30)
    return _measured(
        tickets, snapshot, {"n_open": "count_if(resolved = 0)", "n_tickets_30": f"count_if({month})"}
    )


def from_measures(df: DataFrame, snapshot: str, version: str) -> DataFrame:
    """Feature columns from user_id, signup_date, plan_type and the measures above; `snapshot`
    is SQL text."""

    def number(name: str) -> str:
        return f"double(coalesce({name}, 0))"

    columns = {f"txn_count_{n}d": number(f"n_ok_{n}") for n in WINDOW_DAYS}
    def spend(n: int) -> str:
        return f"CASE WHEN odd_{n} > 0 THEN double('NaN') ELSE {number(f'money_{n}')} END"

    columns |= {f"total_spend_{n}d": spend(n) for n in WINDOW_DAYS}
    columns |= {
        "avg_txn_amount_30d": f"CASE WHEN n_ok_30 > 0 THEN ({spend(30)}) / n_ok_30 ELSE 0D END",
        "failed_txn_rate_30d": guarded_ratio_sql(number("n_failed_30"), number("n_all_30")),
        "days_since_last_txn": f"double(coalesce({days_crossed_sql(snapshot, 'last_ok')}, {NEVER_TRANSACTED}))",
        "open_tickets": number("n_open"),
        "ticket_rate_30d": number("n_tickets_30"),
        "account_age_days": f"double({days_crossed_sql(snapshot, 'signup_date')})",
        "plan_encoded": plan_code_sql("plan_type"),
    }
    return df.selectExpr(
        "user_id AS entity_id",
        f"'{ENTITY_TYPE}' AS entity_type",
        f"'{version}' AS feature_version",
        f"{snapshot} AS event_time",
        *[f"{columns[name]} AS {name}" for name in FEATURES],
    )


def feature_vector(
    users: DataFrame,
    transactions: DataFrame,
    tickets: DataFrame,
    snapshot: datetime,
    version: str = VERSION,
) -> DataFrame:
    """All features of every user as of `snapshot`.

    Each fact table is reduced to one row per user before it meets the users, so rows of one
    fact can never multiply rows of the other.
    """
    joined = (
        users.select("user_id", "signup_date", "plan_type")
        .join(transaction_measures(transactions, snapshot), "user_id", "left")
        .join(ticket_measures(tickets, snapshot), "user_id", "left")
    )
    return from_measures(joined, moment_sql(snapshot), version)
