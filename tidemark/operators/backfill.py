"""Snapshots on a time grid, computed together in one job."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import DAY_MICROS, before, epoch_micros_sql, micros_of, moment, moment_sql
from tidemark.operators.features import FAILED, MONEY, ODD_MONEY, SUCCESS, SUMS, from_measures
from tidemark.schemas import VERSION, WINDOW_DAYS

HOUR_MICROS = 3_600_000_000
ROWS_PER_TASK = 1_000_000


def _steps(days: int, interval_hours: int) -> int:
    if interval_hours < 1 or days < 0:
        raise ValueError("interval_hours must be at least 1 and days at least 0")
    return days * 24 // interval_hours


def spine_start(now: datetime, days: int, interval_hours: int) -> datetime:
    """The oldest snapshot; the grid walks back from `now` and keeps aligned with it."""
    return now - timedelta(hours=interval_hours * _steps(days, interval_hours))


def spine_from(anchors: DataFrame, anchor: str, days: int, interval_hours: int) -> DataFrame:
    """Snapshot times back from the hour of each row's `anchor`, both ends included."""
    steps = _steps(days, interval_hours)
    return anchors.selectExpr(
        f"CAST(date_trunc('hour', {anchor}) AS TIMESTAMP_NTZ) AS _end", f"explode(sequence(0, {steps})) AS _i"
    ).selectExpr(f"_end - make_dt_interval(0, _i * {interval_hours}) AS event_time")


def pending_snapshots(spine: DataFrame, history: DataFrame, version: str = VERSION) -> DataFrame:
    """Snapshots of the grid for which the history holds no row yet."""
    stored = history.where(F.col("feature_version") == version).select("event_time").distinct()
    return spine.join(stored, "event_time", "left_anti")


def backfill_plan(
    spine: DataFrame, history: DataFrame, version: str = VERSION, expected_rows: int = 1
) -> DataFrame:
    """Each snapshot of the grid, marked as stored, partial (fewer rows than expected) or pending."""
    stored = (
        history.where(F.col("feature_version") == version)
        .groupBy("event_time")
        .agg(F.count(F.lit(1)).alias("stored_rows"))
    )
    return spine.join(stored, "event_time", "left").selectExpr(
        "event_time",
        "coalesce(stored_rows, 0) AS stored_rows",
        f"CASE WHEN stored_rows >= {expected_rows} THEN 'stored' WHEN stored_rows > 0 THEN 'partial'"
        " ELSE 'pending' END AS state",
    )


def _first_snapshot_after(shift_days: int, first: datetime, step: int, last: int) -> str:
    """Index of the first snapshot s with s - shift_days > event time, within 0 .. last + 1."""
    offset = f"(at - {micros_of(first) - shift_days * DAY_MICROS}L)"
    return f"int(least(CASE WHEN {offset} < 0 THEN 0 ELSE {offset} div {step}L + 1 END, {last + 1}))"


def _changes(
    facts: DataFrame, measures: dict[str, str], lost_after: dict[int, dict[str, str]],
    carried: dict[str, str], first: datetime, now: datetime, step: int, last: int,
) -> DataFrame:
    """Rows (user_id, idx, changes): what each user's measures gain or lose at a snapshot.

    A fact enters at the first snapshot after it and leaves a window of n days at the first
    snapshot more than n days later. `lost_after[n]` maps an output sum to the measure that
    leaves after n days, with n = 0 for sums that never lose anything; `carried` maps an
    output maximum to its measure. Facts are first summed per user and grid position, so a
    busy user costs at most one row per position and task in the shuffle.
    """
    shifts = sorted({0, *lost_after})
    summed = (
        facts.where(before("event_time", now))
        .withColumn("at", F.expr(epoch_micros_sql("event_time")))
        .withColumns({f"idx_{n}": F.expr(_first_snapshot_after(n, first, step, last)) for n in shifts})
        .groupBy("user_id", *[f"idx_{n}" for n in shifts])
        .agg(*[F.expr(text).alias(name) for name, text in measures.items()])
    )
    moves = ", ".join(f"struct({n} AS leaves, idx_{n} AS idx)" for n in shifts)
    columns = []
    for n, sums in lost_after.items():
        for out, measure in sums.items():
            leaving = f"WHEN move.leaves = {n} THEN -{measure} " if n else ""
            columns.append(f"CASE WHEN move.leaves = 0 THEN {measure} {leaving}END AS {out}")
    columns += [f"CASE WHEN move.leaves = 0 THEN {measure} END AS {out}" for out, measure in carried.items()]
    return (
        summed.withColumn("move", F.expr(f"explode(array({moves}))"))
        .where(f"move.idx <= {last}")
        .selectExpr("user_id", "move.idx AS idx", *columns)
    )


def backfill_history(
    users: DataFrame,
    transactions: DataFrame,
    tickets: DataFrame,
    now: datetime,
    days: int = 90,
    interval_hours: int = 24,
    version: str = VERSION,
    partitions: int | None = None,
) -> DataFrame:
    """Features of every user at every snapshot of the grid that walks back from `now`."""
    first, last = spine_start(now, days, interval_hours), _steps(days, interval_hours)
    return history_on_grid(users, transactions, tickets, first, last, interval_hours, version, partitions)


def backfill_split(
    users: DataFrame,
    transactions: DataFrame,
    tickets: DataFrame,
    at: datetime,
    now: datetime,
    days: int = 90,
    interval_hours: int = 24,
    version: str = VERSION,
) -> tuple[DataFrame, DataFrame]:
    """The rows of `backfill_history` up to `at`, and those after it, each computed on its own part of the grid.

    A condition on the snapshot time does not reach below the running sums, so a filter on the whole history
    would compute all of it for either part. Facts before a part's first snapshot are summed into one change.
    """
    first, last, step = spine_start(now, days, interval_hours), _steps(days, interval_hours), timedelta(hours=interval_hours)
    if not first <= at < now:
        raise ValueError(f"{at} does not part the snapshots from {first} to {now}")
    cut = (at - first) // step
    raw = users, transactions, tickets
    return (
        history_on_grid(*raw, first, cut, interval_hours, version),
        history_on_grid(*raw, first + (cut + 1) * step, last - cut - 1, interval_hours, version),
    )


def _partitions(users: DataFrame, snapshots: int) -> int:
    """About ROWS_PER_TASK output rows for each task, but no core left idle."""
    cores = users.sparkSession.sparkContext.defaultParallelism
    return max(cores, users.count() * snapshots // ROWS_PER_TASK + 1)


def history_on_grid(
    users: DataFrame,
    transactions: DataFrame,
    tickets: DataFrame,
    first: datetime,
    last: int,
    interval_hours: int,
    version: str = VERSION,
    partitions: int | None = None,
    only: list[datetime] | None = None,
) -> DataFrame:
    """Features of every user at `first` and the `last` snapshots after it, or at those in `only`.

    Facts become changes at grid positions and a running sum per user turns the changes into
    windowed values, so the work is linear in facts + output rows; no fact is joined with the
    snapshots it counts for. The snapshot rows are made after the shuffle, from one row per
    user. A user's group holds at most a few rows per grid position, whatever their activity.

    The shuffle gets a fixed number of partitions, by default from the number of rows to come:
    its rows multiply afterwards, so their size before must not decide how many tasks share them.
    """
    partitions = partitions or _partitions(users, last + 1 if only is None else len(only))
    step = interval_hours * HOUR_MICROS
    now = first + timedelta(hours=interval_hours * last)
    month = {"n_failed_30": "failed", "n_all_30": "every"}
    from_transactions = _changes(
        transactions,
        {
            "ok": f"count_if({SUCCESS})",
            "money": f"sum(CASE WHEN {SUCCESS} THEN {MONEY} END)",
            "odd": f"count_if({SUCCESS} AND {ODD_MONEY})",
            "failed": f"count_if({FAILED})",
            "every": "count(1)",
            "latest": f"max(CASE WHEN {SUCCESS} THEN event_time END)",
        },
        {n: {f"n_ok_{n}": "ok", f"money_{n}": "money", f"odd_{n}": "odd"} | (month if n == 30 else {}) for n in WINDOW_DAYS},
        {"last_ok": "latest"},
        first, now, step, last,
    )
    from_tickets = _changes(
        tickets,
        {"unresolved": "count_if(resolved = 0)", "every": "count(1)"},
        {0: {"n_open": "unresolved"}, 30: {"n_tickets_30": "every"}},
        {},
        first, now, step, last,
    )
    changes = (
        from_transactions.unionByName(from_tickets, allowMissingColumns=True)
        .repartition(partitions, "user_id")
        .groupBy("user_id", "idx")
        .agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last_ok").alias("last_ok"))
    )
    times = f"sequence({moment_sql(first)}, {moment_sql(now)}, INTERVAL '{interval_hours}' HOUR)"
    subjects = (
        users.select("user_id", "signup_date", "plan_type")
        .repartition(partitions, "user_id")
        .selectExpr("*", f"posexplode({times}) AS (idx, snapshot)")
    )
    if only is not None:  # a running sum needs all changes, but no row at the other snapshots
        subjects = subjects.where(F.col("snapshot").isin([moment(t) for t in only]))
    so_far = Window.partitionBy("user_id").orderBy("idx").rangeBetween(Window.unboundedPreceding, 0)
    running = subjects.unionByName(changes, allowMissingColumns=True).select(
        "user_id", "signup_date", "plan_type", "snapshot",
        *[F.sum(c).over(so_far).alias(c) for c in SUMS],
        F.max("last_ok").over(so_far).alias("last_ok"),
    ).where("snapshot IS NOT NULL")
    return from_measures(running, "snapshot", version)
