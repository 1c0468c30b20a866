import math
import random
from datetime import timedelta
from statistics import NormalDist

import numpy as np
import pytest
from raw_data import NOW

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import distribution as d
from tidemark.operators.running import at_ranks, chunked, running_totals

LONG = "feature_name string, value double"


def _normal(mean, std, n=500):
    """A sample with the given moments: normal quantiles at even steps."""
    return [mean + std * NormalDist().inv_cdf((i + 0.5) / n) for i in range(n)]


def _history(make_history, values, name="txn_count_7d", at=NOW):
    return make_history([(i, at, {name: v}) for i, v in enumerate(values)])


@pytest.mark.parametrize("chunks", [1, 3, 16])
def test_running_totals(spark, chunks):
    rng = random.Random(chunks)
    # One group holds most rows.
    rows = [(rng.choice("aaaaaab"), i, rng.randrange(-5, 50)) for i in range(300)] + [("c", 1, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o int, m int")
    got = running_totals(df, ["g"], "o", {"m": "upto"}, {"o": "sum_o"}, buckets=chunks, chunk_rows=20).collect()
    assert len(got) == len(rows)
    for r in got:
        same = [x for x in rows if x[0] == r.g]
        upto = [x[2] for x in same if x[1] <= r.o and x[2] is not None]
        if r.g != "c":
            assert r.upto == sum(upto) and r.upto_all == sum(x[2] for x in same)
        assert r.sum_o == sum(x[1] for x in same)


ODD = [None, float("-inf"), -1e308, -7.5, -0.0, 1e-300, 3.0, 3.5, 1e308, float("inf"), float("nan")]


@pytest.mark.parametrize("buckets, rows", [(1, 1), (1, 100), (4, 2), (1024, 100_000)])
def test_ranks_and_totals_of_odd_values(spark, buckets, rows):
    """NULL sorts first and NaN last; infinite and huge values must not upset the chunks; a NULL group is a group."""
    data = [(g, v, k % 3 + 1) for g in ("a", None) for k, v in enumerate(ODD)] + [("b", float("nan"), 2), ("c", None, 1)]
    df = spark.createDataFrame(data, "g string, v double, n long")
    spread = {g: [v for h, v, n in data if h == g for _ in range(n)] for g in ("a", None, "b", "c")}
    same = lambda x, y: x == y or (x is not None and y is not None and math.isnan(x) and math.isnan(y))
    ranks = {"first": "0L", "middle": "total div 2", "last": "total - 1", "past": "total"}
    got = {r.g: r for r in at_ranks(df, ["g"], "v", "n", ranks, buckets=buckets, chunk_rows=rows).collect()}
    assert set(got) == set(spread)
    for g, values in spread.items():
        n = len(values)
        assert got[g].total == n and got[g].past is None
        assert all(same(got[g][name], values[k]) for name, k in (("first", 0), ("middle", n // 2), ("last", n - 1)))
    for r in running_totals(df, ["g"], "v", {"n": "upto"}, buckets=buckets, chunk_rows=rows).collect():
        held = spread[r.g]
        assert r.upto_all == len(held) and r.upto == max(k for k, v in enumerate(held, 1) if same(v, r.v))


def test_chunks_grow_with_the_rows_of_a_bucket(spark):
    """Values crowded in a thousandth of the range still fall into many chunks."""
    df = spark.createDataFrame([("a", k / 1e6) for k in range(1000)] + [("a", 1000.0)], "g string, v double")
    sizes = [r["count"] for r in chunked(df, ["g"], "v", 16, 50).groupBy("_g", "_bucket", "_part").count().collect()]
    assert max(sizes) <= 51 and sum(sizes) == 1001


def test_no_job_and_no_file_before_the_result_is_asked_for(spark, make_history, monkeypatch):
    written = []
    monkeypatch.setattr(session, "new_path", lambda *a: written.append(a))
    spark.sparkContext.setJobGroup("ranking", "ranking")
    try:
        history = _history(make_history, [1.0, 2.0, 3.0])
        frames = [d.feature_stats(history), d.skew_report(history, history)]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ranking")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [f.count() for f in frames] == [13, 13] and not written


def test_stats_of_two_values(make_history):
    stats = {r.feature_name: r for r in d.feature_stats(_history(make_history, [10.0, 20.0])).collect()}
    row = stats["txn_count_7d"]
    assert (row["mean"], row["std"], row.p25, row.p50, row.p75, row.null_rate, row.sample_count) == (
        15.0, 5.0, 12.5, 15.0, 17.5, 0.0, 2
    )
    assert len(stats) == 13


@pytest.mark.parametrize("chunks", [1, 7])
def test_stats_against_numpy(make_history, chunks):
    rng = random.Random(3)
    # A third of the rows share one value; others are scattered far from zero; some are missing.
    values = [1e6] * 100 + [1e6 + rng.gauss(0, 50) for _ in range(200)]
    history = _history(make_history, values + [None] * 20)
    row = d.feature_stats(history, buckets=chunks, chunk_rows=10).where("feature_name = 'txn_count_7d'").first()
    assert row.sample_count == 320 and row.null_rate == 20 / 320
    assert math.isclose(row["mean"], np.mean(values), rel_tol=1e-12)
    assert math.isclose(row["std"], np.std(values), rel_tol=1e-9)
    for name, q in d.QUANTILES.items():
        assert math.isclose(row[name], np.quantile(values, q), rel_tol=1e-12)


def test_empty_features_are_left_out(make_history):
    names = {r.feature_name for r in d.feature_stats(_history(make_history, [None, None])).collect()}
    assert "txn_count_7d" not in names and len(names) == 12
    nothing = d.window_rows(_history(make_history, [1.0]), NOW - timedelta(days=9), 1)
    assert d.feature_stats(nothing).count() == 0


def test_window_has_both_ends(make_history):
    history = make_history([(i, NOW - timedelta(days=i), {}) for i in range(4)])
    assert {r.entity_id for r in d.window_rows(history, NOW - timedelta(days=1), 1).collect()} == {1, 2}
    assert d.window_rows(history, NOW, 7, "v2").count() == 0


def test_null_rate(make_history):
    rates = {r.feature_name: r.null_rate for r in d.null_rate(_history(make_history, [1.0, None, float("nan"), 0.0])).collect()}
    assert rates["txn_count_7d"] == 0.5 and rates["open_tickets"] == 0.0


def _ks(spark, a, b, **cut):
    frames = [spark.createDataFrame([("f", v) for v in side], LONG) for side in (a, b)]
    row = d.ks_statistic(*frames, **cut).withColumn(
        "p", d.ks_pvalue(F.col("ks_statistic"), F.col("n_training"), F.col("n_serving"))
    ).first()
    return row


@pytest.mark.parametrize("chunks", [1, 5])
def test_distance_against_brute_force(spark, chunks):
    rng = random.Random(11)
    a = [float(rng.randrange(30)) for _ in range(200)] + [7.0] * 100
    b = [float(rng.randrange(10, 45)) for _ in range(150)]
    expected = max(abs(np.mean([x <= v for x in a]) - np.mean([x <= v for x in b])) for v in {*a, *b})
    row = _ks(spark, a + [None, float("nan")], b + [None], buckets=chunks, chunk_rows=10)
    assert math.isclose(row.ks_statistic, expected, rel_tol=1e-12)
    assert (row.n_training, row.n_serving) == (300, 150)


def test_pvalue(spark):
    # Known points of the limit distribution.
    points = spark.createDataFrame([(1.36, 0.0495), (1.22, 0.1019), (1.63, 0.0098), (0.0, 1.0), (0.1, 1.0)], "x double, p double")
    n = F.lit(2_000_000)
    got = points.withColumn("q", d.ks_pvalue(F.col("x") / 1000, n, n)).collect()
    for r in got:
        assert abs(r.q - r.p) < 5e-4
    big = points.limit(1).select(d.ks_pvalue(F.lit(0.5), F.lit(4 * 10**12), F.lit(4 * 10**12)).alias("q")).first()
    assert big.q == 0.0


def test_report(make_history):
    base = _normal(10, 2)
    same = {r.feature_name: r for r in d.skew_report(_history(make_history, base), _history(make_history, base)).collect()}
    assert not same["txn_count_7d"].flagged and same["txn_count_7d"].ks_pvalue == 1.0
    assert same["open_tickets"].ks_statistic == 0.0 and same["open_tickets"].training_std == 0.0
    near = d.skew_report(_history(make_history, base), _history(make_history, _normal(10.1, 2)))
    assert d.skew_flag_counts(near).first().asDict() == {"flagged": 0, "total": 13}
    far = d.skew_report(_history(make_history, base), _history(make_history, _normal(50, 2)))
    first = far.first()
    assert first.feature_name == "txn_count_7d" and first.flagged and first.ks_pvalue < 0.05
    assert first.mean_shift > 19 and first.serving_sample_count == 500
    assert len(far.columns) == 13
    assert d.skew_flag_counts(far).first().flagged == 1


def test_empty_window_gives_an_empty_report(make_history):
    history = _history(make_history, [1.0, 2.0])
    assert d.skew_report(history, history.limit(0)).count() == 0
    assert d.skew_report(history.limit(0), history).count() == 0


def test_summary_from_stored_statistics(spark, make_history):
    stored = spark.createDataFrame(
        [("a", "txn_count_7d", "v1", "training", 10.0, 2.0, 8.0, 10.0, 12.0, 14.0, 0.0, 500, NOW)],
        "snapshot_id string, feature_name string, feature_version string, context string, mean double, std double, "
        "p25 double, p50 double, p75 double, p95 double, null_rate double, sample_count bigint, captured_at timestamp_ntz",
    )
    later = stored.selectExpr("* EXCEPT (captured_at, mean)", "captured_at + INTERVAL 1 DAY AS captured_at", "11D AS mean")
    latest = d.latest_snapshot(stored.unionByName(later), "training")
    assert [r["mean"] for r in latest.collect()] == [11.0]
    serving = d.feature_stats(_history(make_history, [10.0] * 5))
    rows = d.skew_summary(stored, serving).collect()
    assert len(rows) == 1
    assert (rows[0].training_mean, rows[0].serving_mean, rows[0].serving_sample_count) == (10.0, 10.0, 5)
    assert d.skew_summary(d.latest_snapshot(stored, "serving"), serving).count() == 0
