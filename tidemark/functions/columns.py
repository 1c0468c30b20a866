"""Small expressions: times, windows, ratios, codes, money.

The helpers named `*_sql` give SQL text for `expr` and `selectExpr`; wide projections are written
that way because each is then parsed in one call instead of being built node by node.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import OTHER_PLAN_CODE, PLAN_CODES

DAY_MICROS = 86_400_000_000


def moment_sql(t: datetime) -> str:
    """A literal time without a zone, so that no session time zone can move it."""
    return f"TIMESTAMP_NTZ '{t.isoformat(sep=' ')}'"


def moment(t: datetime) -> Column:
    return F.expr(moment_sql(t))


def before(column: str, t: datetime) -> Column:
    return F.expr(f"{column} < {moment_sql(t)}")


def in_window_sql(column: str, end: datetime, days: int) -> str:
    """Half-open window: `end - days` is inside, `end` is not."""
    return f"({column} >= {moment_sql(end - timedelta(days=days))} AND {column} < {moment_sql(end)})"


def in_window(column: str, end: datetime, days: int) -> Column:
    return F.expr(in_window_sql(column, end, days))


def days_crossed_sql(later: str, earlier: str) -> str:
    """Midnights between two times, not whole 24-hour spans."""
    return f"datediff(to_date({later}), to_date({earlier}))"


def epoch_micros_sql(t: str) -> str:
    """Microseconds since 1970 of a time without a zone, as bigint."""
    return (
        f"(unix_date(to_date({t})) * {DAY_MICROS}L + (hour({t}) * 3600 + minute({t}) * 60) * 1000000L"
        f" + bigint(extract(SECOND FROM {t}) * 1000000))"
    )


def epoch_micros(column: str) -> Column:
    return F.expr(epoch_micros_sql(column))


def micros_of(t: datetime) -> int:
    return (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def snapshot_id(column: str) -> Column:
    """Folder name of a snapshot, sorting as its time does."""
    return F.expr(f"substring(translate(string({column}), '- :', ''), 1, 14)")


def snapshot_name(t: datetime) -> str:
    return t.strftime("%Y%m%d%H%M%S")


def guarded_ratio_sql(part: str, whole: str) -> str:
    return f"({part} / greatest({whole}, 1))"


def guarded_ratio(part: str, whole: str) -> Column:
    return F.expr(guarded_ratio_sql(part, whole))


def plan_code_sql(column: str) -> str:
    """Ordinal code of a plan; a missing or unknown plan counts as the highest one."""
    known = " ".join(f"WHEN '{plan}' THEN {code}" for plan, code in PLAN_CODES.items())
    return f"double(CASE {column} {known} ELSE {OTHER_PLAN_CODE} END)"


def money_sql(column: str) -> str:
    """Money as a decimal number: its sums are exact and do not depend on the order of the rows.

    NULL for amounts that are not finite or too large; `odd_money_sql` tells them from missing ones.
    """
    return f"try_cast({column} AS DECIMAL(28, 8))"


def odd_money_sql(column: str) -> str:
    return f"({column} IS NOT NULL AND {money_sql(column)} IS NULL)"


def missing_sql(column: str) -> str:
    return f"({column} IS NULL OR isnan({column}))"


def missing(column: str) -> Column:
    return F.expr(missing_sql(column))


def per_feature(counted: DataFrame, names: list[str], columns: dict[str, str], *keep: str) -> DataFrame:
    """Turn one row with a column per feature and measure into one row per feature.

    `columns` maps an output column to the pattern of its inputs, "{}" standing for the feature.
    """
    rows = ", ".join(
        f"'{name}', " + ", ".join(pattern.format(name) for pattern in columns.values()) for name in names
    )
    outputs = ", ".join(["feature_name", *columns])
    return counted.selectExpr(*keep, f"stack({len(names)}, {rows}) AS ({outputs})")
