"""Running state per user, advanced from one snapshot to the next by the facts at the window edges.

The state at a snapshot holds each user's measures there: windowed sums and counts, open tickets, the
last success. To reach a later snapshot only two kinds of facts are read: those that arrived in
between, and those that leave a window of n days, which lie n days before them. So a daily step over
years of facts reads one day at four places, whatever came before, and stored facts with time
statistics or date folders are pruned to them.

Counts of open tickets use the resolved flag as it was when a ticket arrived; a ticket resolved
later counts as open until the state is made anew from all facts.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import moment_sql
from tidemark.operators.features import FAILED, MONEY, ODD_MONEY, SUCCESS, SUMS, from_measures, ticket_measures, transaction_measures
from tidemark.schemas import VERSION, WINDOW_DAYS

STATE = ", ".join([
    "user_id bigint", *[f"{c} {'decimal(38,8)' if c.startswith('money') else 'bigint'}" for c in SUMS], "last_ok timestamp_ntz",
])
_COLUMNS = [*SUMS, "last_ok"]


def _typed(measures: DataFrame) -> DataFrame:
    """The columns of `STATE` in order; sums that a side does not have, or has none of, are 0."""
    kinds = dict(part.strip().split(" ") for part in STATE.replace("(38,8)", "(38;8)").split(","))
    columns = [
        f"CAST({c if c in measures.columns else 'NULL'} AS {kind.replace(';', ',')}) AS {c}" if c in ("user_id", "last_ok")
        else f"CAST(coalesce({c if c in measures.columns else 'NULL'}, 0) AS {kind.replace(';', ',')}) AS {c}"
        for c, kind in kinds.items()
    ]
    return measures.selectExpr(*columns)


def _summed(parts: list[DataFrame]) -> DataFrame:
    """One row per user from rows of `STATE`: sums add up, the last success is the latest."""
    rows = _typed(parts[0])
    for part in parts[1:]:
        rows = rows.unionByName(_typed(part))
    sums = rows.groupBy("user_id").agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last_ok").alias("last_ok"))
    return _typed(sums)


def state_at(transactions: DataFrame, tickets: DataFrame, snapshot: datetime) -> DataFrame:
    """The state at a snapshot from all facts before it, with a row for every user that has any."""
    return _summed([transaction_measures(transactions, snapshot), ticket_measures(tickets, snapshot)])


def _between(start: datetime, end: datetime, days: int) -> str:
    """Facts that lie `days` before the time between two snapshots."""
    low, high = (t - timedelta(days=days) for t in (start, end))
    return f"(event_time >= {moment_sql(low)} AND event_time < {moment_sql(high)})"


def _moved(facts: DataFrame, at: datetime, to: datetime, entering: dict[str, tuple[int, str, str]], carried: dict[str, str]) -> DataFrame:
    """What the measures gain and lose between two snapshots, per user.

    `entering` maps a measure to its window in days (0 for one that loses nothing), the aggregate of
    what it takes in and the value that stands for no fact; `carried` maps a maximum to its value.
    """
    windows = sorted({0, *(days for days, _, _ in entering.values())})
    edges = {n: _between(at, to, n) for n in windows}
    columns = []
    for name, (days, aggregate, value) in entering.items():
        gained = aggregate.format(f"{edges[0]} AND {value}")
        lost = f" - {aggregate.format(f'{edges[days]} AND {value}')}" if days else ""
        columns.append(F.expr(f"{gained}{lost}").alias(name))
    columns += [F.expr(f"max(CASE WHEN {edges[0]} THEN {value} END)").alias(name) for name, value in carried.items()]
    return facts.where(" OR ".join(edges.values())).groupBy("user_id").agg(*columns)


def advance(state: DataFrame, transactions: DataFrame, tickets: DataFrame, at: datetime, to: datetime) -> DataFrame:
    """The state at `to`, from the state at `at` and the facts at the edges of the windows.

    A fact may leave a window that it entered in the same step, when the step is longer than the window.
    """
    if to < at:
        raise ValueError("a state only moves forward")
    count, money = "count_if({})", f"coalesce(sum(CASE WHEN {{}} THEN {MONEY} END), 0)"
    from_transactions = {}
    for n in WINDOW_DAYS:
        from_transactions[f"n_ok_{n}"] = (n, count, SUCCESS)
        from_transactions[f"money_{n}"] = (n, money, SUCCESS)
        from_transactions[f"odd_{n}"] = (n, count, f"{SUCCESS} AND {ODD_MONEY}")
    from_transactions["n_failed_30"] = (30, count, FAILED)
    from_transactions["n_all_30"] = (30, count, "true")
    from_tickets = {"n_open": (0, count, "resolved = 0"), "n_tickets_30": (30, count, "true")}
    return _summed([
        state,
        _moved(transactions, at, to, from_transactions, {"last_ok": f"CASE WHEN {SUCCESS} THEN event_time END"}),
        _moved(tickets, at, to, from_tickets, {}),
    ])


def features_of(state: DataFrame, users: DataFrame, snapshot: datetime, version: str = VERSION) -> DataFrame:
    """The features of every user at the snapshot of a state."""
    joined = users.select("user_id", "signup_date", "plan_type").join(state, "user_id", "left")
    return from_measures(joined, moment_sql(snapshot), version)
