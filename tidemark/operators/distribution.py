"""Distribution statistics of features, and drift between a training and a serving window."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import guarded_ratio_sql, missing_sql, moment, per_feature
from tidemark.operators.running import at_ranks, running_totals
from tidemark.schemas import FEATURES, KS_THRESHOLD, VERSION
from tidemark.sources.tables import scan_history

# Reported quantiles and the smallest spread that a shift is measured in.
QUANTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p95": 0.95}
SMALLEST_STD = 1e-6


def window_rows(history: DataFrame, as_of: datetime, since_days: int, version: str = VERSION) -> DataFrame:
    """History of the last `since_days` days up to `as_of`, both ends included."""
    return scan_history(history, version, as_of - timedelta(days=since_days), as_of)


def long_form(history: DataFrame, *keep: str) -> DataFrame:
    """One row per entity row and feature."""
    return history.unpivot(list(keep), FEATURES, "feature_name", "value")


def null_rate(rows: DataFrame) -> DataFrame:
    """Per feature, the share of missing values, from one pass over the rows."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.expr(f"count_if({missing_sql(c)})").alias(c) for c in FEATURES]
    )
    columns = {"n_missing": "{}", "null_rate": guarded_ratio_sql("{}", "n")}
    return per_feature(counts, FEATURES, columns, "n AS sample_count")


def _counted(sides: dict[str, DataFrame]) -> DataFrame:
    """Distinct values per feature over all sides, with how often each side has them.

    `sides` maps a suffix to (feature_name, value) rows, perhaps with `n`, the rows that each stands
    for. Per suffix s the result has all_s (rows with the value), n_s (the same without NULLs),
    weighted_s (their sum) and number_s (rows whose value is a number). Copies of a value merge before
    the shuffle, however common it is.
    """
    long = None
    for s, rows in sides.items():
        n = "n" if "n" in rows.columns else "1L"
        side = rows.selectExpr("feature_name", "value", *[f"{n if s == other else '0L'} AS is_{other}" for other in sides])
        long = side if long is None else long.unionByName(side)
    counts = long.groupBy("feature_name", "value").agg(*[F.sum(f"is_{s}").alias(f"all_{s}") for s in sides])
    measures = {}
    for s in sides:
        measures[f"n_{s}"] = f"CASE WHEN value IS NULL THEN 0L ELSE all_{s} END"
        measures[f"weighted_{s}"] = f"CASE WHEN all_{s} > 0 THEN value * all_{s} END"
        measures[f"number_{s}"] = f"CASE WHEN {missing_sql('value')} THEN 0L ELSE all_{s} END"
    return counts.withColumns({name: F.expr(text) for name, text in measures.items()})


def _whole(sides) -> dict[str, str]:
    """Measures of `_counted` and the names of their group sums: rows, sum of the values, numbers."""
    out = {}
    for s in sides:
        out |= {f"all_{s}": f"rows_{s}", f"weighted_{s}": f"sum_{s}", f"number_{s}": f"valid_{s}"}
    return out


def _ranked(sides: dict[str, DataFrame], **cut) -> DataFrame:
    """The rows of `_counted` with upto_s, the ranks used up to the value, and the group sums
    upto_s_all (values), rows_s (rows), sum_s (of the values) and valid_s (values that are numbers)."""
    running = {f"n_{s}": f"upto_{s}" for s in sides}
    return running_totals(_counted(sides), ["feature_name"], "value", running, _whole(sides), **cut)


def _moment_columns(s: str) -> dict[str, str]:
    """Aggregates of values with their group sums that give moments and counts of side `s`."""
    mean = f"(sum_{s} / upto_{s}_all)"
    return {
        f"mean_{s}": f"max({mean})",
        f"std_{s}": f"sqrt(sum((value - {mean}) * (value - {mean}) * n_{s}) / max(upto_{s}_all))",
        f"present_{s}": f"max(upto_{s}_all)",
        f"sample_count_{s}": f"max(rows_{s})",
        f"missing_{s}": f"max(rows_{s} - valid_{s})",
    }


def _quantile_ranks(s: str, total: str) -> dict[str, str]:
    """The two ranks that each quantile of side `s` lies between."""
    ends = (("low", "floor"), ("high", "ceil"))
    return {f"{name}_{end}_{s}": f"{edge}(({total} - 1) * {q}D)" for name, q in QUANTILES.items() for end, edge in ends}


def _stats_columns(s: str) -> dict[str, str]:
    """Aggregates of ranked values that give the statistics of side `s` in `_stats_of`."""
    columns = _moment_columns(s)
    for name, rank in _quantile_ranks(s, f"upto_{s}_all").items():
        inside = f"n_{s} > 0 AND upto_{s} - n_{s} <= {rank} AND {rank} < upto_{s}"
        columns[name] = f"max(CASE WHEN {inside} THEN value END)"
    return columns


def _stats_of(s: str) -> dict[str, str]:
    """Statistics from the aggregates of `_stats_columns`; quantiles lie between two ranks."""
    stats = {"mean": f"mean_{s}", "std": f"std_{s}"}
    for name, q in QUANTILES.items():
        position = f"(present_{s} - 1) * {q}D"
        low, high = f"{name}_low_{s}", f"{name}_high_{s}"
        stats[name] = f"{low} + ({high} - {low}) * ({position} - floor({position}))"
    stats["null_rate"] = guarded_ratio_sql(f"missing_{s}", f"sample_count_{s}")
    stats["sample_count"] = f"sample_count_{s}"
    return stats


def _aggregate(ranked: DataFrame, columns: dict[str, str]) -> DataFrame:
    return ranked.groupBy("feature_name").agg(*[F.expr(text).alias(name) for name, text in columns.items()])


def feature_stats(rows: DataFrame, **cut) -> DataFrame:
    """Mean, population deviation, exact interpolated quantiles, share of missing values and
    number of rows per feature. A feature without any value is left out.

    Everything follows from the distinct values and their counts. Quantiles are selected by
    counting: no feature's values are put in order as a whole.
    """
    counts = _counted({"a": long_form(rows)})
    sums = {"n_a": "upto_a_all"} | _whole("a")
    totals = counts.groupBy("feature_name").agg(*[F.sum(m).alias(name) for m, name in sums.items()]).where("upto_a_all > 0")
    moments = _aggregate(counts.join(F.broadcast(totals), "feature_name"), _moment_columns("a"))
    values = at_ranks(counts.where("n_a > 0"), ["feature_name"], "value", "n_a", _quantile_ranks("a", "total"), **cut)
    columns = [f"{text} AS {name}" for name, text in _stats_of("a").items()]
    return moments.join(F.broadcast(values), "feature_name").selectExpr("feature_name", *columns)


def skew_snapshot(
    history: DataFrame, context: str, as_of: datetime, since_days: int, snapshot_id: str, version: str = VERSION
) -> DataFrame:
    """Statistics of one window as rows of the snapshot log."""
    return feature_stats(window_rows(history, as_of, since_days, version)).select(
        F.lit(snapshot_id).alias("snapshot_id"),
        "feature_name",
        F.lit(version).alias("feature_version"),
        F.lit(context).alias("context"),
        "mean", "std", *QUANTILES, "null_rate", "sample_count",
        moment(as_of).alias("captured_at"),
    )


def latest_snapshot(snapshots: DataFrame, context: str, version: str = VERSION) -> DataFrame:
    """Per feature, the row captured last in the given context."""
    last = Window.partitionBy("feature_name").orderBy(F.desc("captured_at"), F.desc("snapshot_id"))
    known = snapshots.where((F.col("feature_version") == version) & (F.col("context") == context))
    return known.withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") == 1).drop("_rank")


def _summary_columns(training: dict[str, str], serving: dict[str, str]) -> dict[str, str]:
    shift = f"abs({training['mean']} - {serving['mean']}) / greatest({training['std']}, {SMALLEST_STD}D)"
    columns = {}
    for name, side in (("training", training), ("serving", serving)):
        columns |= {f"{name}_{c}": f"round({side[c]}, 4)" for c in ("mean", "std", "p50")}
    columns["mean_shift"] = f"round({shift}, 4)"
    columns["training_sample_count"] = training["sample_count"]
    columns["serving_sample_count"] = serving["sample_count"]
    return columns


def skew_summary(training: DataFrame, serving: DataFrame) -> DataFrame:
    """Both sides' statistics per feature and the shift of the mean in training deviations.

    Takes statistics, perhaps from the snapshot log, with one row per feature. A feature missing
    on either side is left out.
    """
    names = ("mean", "std", "p50", "sample_count")
    both = training.selectExpr("feature_name", *[f"{c} AS tr_{c}" for c in names]).join(
        serving.selectExpr("feature_name", *[f"{c} AS sv_{c}" for c in names]), "feature_name"
    )
    columns = _summary_columns({c: f"tr_{c}" for c in names}, {c: f"sv_{c}" for c in names})
    return both.selectExpr("feature_name", *[f"{text} AS {name}" for name, text in columns.items()])


def _ks_columns() -> dict[str, str]:
    gap = "abs(upto_a / valid_a - upto_b / valid_b)"
    return {
        "ks_statistic": f"max(CASE WHEN NOT {missing_sql('value')} THEN {gap} END)",
        "n_training": "max(valid_a)",
        "n_serving": "max(valid_b)",
    }


def ks_statistic(training: DataFrame, serving: DataFrame, **cut) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance of (feature_name, value) rows, per feature.

    Missing values take no part; a feature without values on one side is left out.
    """
    ranked = _ranked({"a": training, "b": serving}, **cut).where("valid_a > 0 AND valid_b > 0")
    return _aggregate(ranked, _ks_columns())


def ks_pvalue(statistic: Column, n_training: Column, n_serving: Column) -> Column:
    """Limit distribution of the distance: 2 * sum over k of (-1)^(k-1) exp(-2 k^2 x^2).

    Near zero the alternating series has not converged after its first terms, while the true
    value is one to many digits.
    """
    n, m = n_training.cast("double"), n_serving.cast("double")
    x = F.sqrt(n * m / (n + m)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


def ks_test(training: DataFrame, serving: DataFrame) -> DataFrame:
    tested = ks_statistic(training, serving)
    return tested.withColumn(
        "ks_pvalue", ks_pvalue(F.col("ks_statistic"), F.col("n_training"), F.col("n_serving"))
    )


def baseline(
    history: DataFrame, context: str, as_of: datetime, since_days: int, snapshot_id: str, version: str = VERSION
) -> DataFrame:
    """The values of one window with their numbers of rows, as rows of the table of baselines.

    An exact empirical distribution, much smaller than the rows where values repeat. Baselines of
    disjoint sets of rows merge by adding up, see `merged_baselines`.
    """
    counts = long_form(window_rows(history, as_of, since_days, version)).groupBy("feature_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select(
        F.lit(snapshot_id).alias("snapshot_id"), "feature_name", F.lit(version).alias("feature_version"),
        F.lit(context).alias("context"), "value", "n", moment(as_of).alias("captured_at"),
    )


def merged_baselines(baselines: DataFrame) -> DataFrame:
    """(feature_name, value, n) of the union of the windows, which must not overlap."""
    return baselines.groupBy("feature_name", "value").agg(F.sum("n").alias("n"))


def latest_baseline(baselines: DataFrame, context: str, version: str = VERSION) -> DataFrame:
    """(feature_name, value, n) of the baseline captured last in the given context."""
    known = baselines.where((F.col("feature_version") == version) & (F.col("context") == context))
    last = known.agg(F.max(F.struct("captured_at", "snapshot_id")).alias("last")).select("last.snapshot_id")
    return known.where(F.col("snapshot_id") == last.scalar()).select("feature_name", "value", "n")


def skew_report(training_rows: DataFrame, serving_rows: DataFrame, **cut) -> DataFrame:
    """`skew_report_of` two sets of history rows."""
    return skew_report_of(long_form(training_rows), long_form(serving_rows), **cut)


def skew_report_of(training: DataFrame, serving: DataFrame, **cut) -> DataFrame:
    """Full drift report, flagged features first, then by distance.

    Both sides are (feature_name, value) rows, or (feature_name, value, n) as a baseline holds them.

    Statistics and test come from one ranking of the values of both windows. The report is empty
    when either window is: a feature without serving rows is left out rather than compared with
    an invented zero.
    """
    ranked = _ranked({"a": training, "b": serving}, **cut)
    figures = _aggregate(
        ranked.where("valid_a > 0 AND valid_b > 0"),
        _stats_columns("a") | _stats_columns("b") | _ks_columns(),
    )
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_training"), F.col("n_serving"))
    columns = _summary_columns(_stats_of("a"), _stats_of("b"))
    return (
        figures.withColumn("p", p)
        .selectExpr(
            "feature_name",
            *[f"{text} AS {name}" for name, text in columns.items()],
            f"p < {KS_THRESHOLD}D AS flagged",
            "round(ks_statistic, 4) AS ks_statistic",
            "round(p, 4) AS ks_pvalue",
        )
        .orderBy(F.desc("flagged"), F.desc("ks_statistic"), "feature_name")
    )


def skew_flag_counts(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if("flagged").alias("flagged"), F.count(F.lit(1)).alias("total"))
