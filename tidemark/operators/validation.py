"""Row rules of the feature table, cleaning, and the split into valid and quarantined rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import FEATURES

# Smallest id, allowed plan codes and the tolerance for a rate just above one.
SMALLEST_ID = 1
ALLOWED_PLAN_CODES = [0.0, 1.0, 2.0, 3.0]
RATE_TOLERANCE = 1.01
RATE = "failed_txn_rate_30d"


@dataclass(frozen=True)
class Rule:
    column: str
    name: str
    holds: str

    @property
    def id(self) -> str:
        return f"{self.column}:{self.name}"

    @property
    def broken(self) -> str:
        """A missing value breaks the rule against missing values only."""
        return f"NOT coalesce({self.holds}, true)"


def rules() -> list[Rule]:
    found = [
        Rule("entity_id", "not_null", "entity_id IS NOT NULL"),
        Rule("entity_id", "at_least_1", f"entity_id >= {SMALLEST_ID}"),
    ]
    for name in FEATURES:
        found.append(Rule(name, "not_null", f"{name} IS NOT NULL"))
        if name == "plan_encoded":
            codes = ", ".join(f"{code}D" for code in ALLOWED_PLAN_CODES)
            found.append(Rule(name, "known_code", f"{name} IN ({codes})"))
            continue
        found.append(Rule(name, "at_least_0", f"{name} >= 0"))
        if name == RATE:
            found.append(Rule(name, "at_most_1", f"{name} <= 1"))
    return found


def clean(df: DataFrame) -> DataFrame:
    """Numbers as double, missing values as 0, and the rate's rounding noise removed.

    Text that is no number becomes NULL and fails its rule later. A rate in (1, 1.01] counts as
    1 and one below 0 as 0; a rate further above 1 stays and fails. NaN sorts above every
    number, so it has to go before any rule looks at the value.
    """
    cleaned = {}
    for name in FEATURES:
        number = f"try_cast({name} AS double)"
        text = f"CASE WHEN {name} IS NULL OR isnan({number}) THEN 0D ELSE {number} END"
        if name == RATE:
            text = (
                f"CASE WHEN {text} > 1 AND {text} <= {RATE_TOLERANCE}D THEN 1D "
                f"WHEN {text} < 0 THEN 0D ELSE {text} END"
            )
        cleaned[name] = text
    return df.selectExpr(*[f"{cleaned[c]} AS {c}" if c in cleaned else f"`{c}`" for c in df.columns])


def with_violations(df: DataFrame) -> DataFrame:
    """Add `violations`, the ids of all rules that the row breaks."""
    broken = ", ".join(f"CASE WHEN {r.broken} THEN '{r.id}' END" for r in rules())
    return df.withColumn("violations", F.expr(f"array_compact(array({broken}))"))


def validate(df: DataFrame) -> DataFrame:
    return with_violations(clean(df))


def _all_hold() -> str:
    """Whether a cleaned row breaks no rule: the same as no `violations`, without making the list of them."""
    return f"NOT ({' OR '.join(r.broken for r in rules())})"


def valid_rows(df: DataFrame) -> DataFrame:
    return clean(df).where(_all_hold())


def quarantined_rows(df: DataFrame) -> DataFrame:
    return with_violations(clean(df).where(f"NOT {_all_hold()}"))


def violation_counts(df: DataFrame) -> DataFrame:
    """One row per broken rule with the number of rows that break it, from one pass."""
    checks = rules()
    counted = clean(df).agg(*[F.expr(f"count_if({r.broken})").alias(f"c{i}") for i, r in enumerate(checks)])
    stacked = ", ".join(f"'{r.column}', '{r.name}', c{i}" for i, r in enumerate(checks))
    return counted.selectExpr(f"stack({len(checks)}, {stacked}) AS (column, rule, n_rows)").where("n_rows > 0")
