"""Run records and served-request records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import epoch_micros, guarded_ratio
from tidemark.operators.running import at_ranks
from tidemark.schemas import ENTITY_TYPE, VERSION

# Longest kept error text, limits of the recent-runs report, reported percentiles.
ERROR_LENGTH = 500
MAX_RECENT = 1000
PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
# The paths a request may be served by.
PATHS = ["online_store", "on_demand", "batch"]


def run_status(processed: Column, failed: Column) -> Column:
    return F.when(failed == 0, "success").when(processed > 0, "partial").otherwise("failed")


def run_records(runs: DataFrame, version: str = VERSION) -> DataFrame:
    """Log rows from columns run_id, processed, entities_failed, status, error, started_at and
    completed_at."""
    millis = (epoch_micros("completed_at") - epoch_micros("started_at")) / 1000
    return runs.select(
        "run_id",
        F.lit(version).alias("feature_version"),
        F.lit(ENTITY_TYPE).alias("entity_type"),
        F.col("processed").cast("bigint").alias("entities_processed"),
        F.col("entities_failed").cast("bigint").alias("entities_failed"),
        F.floor(millis).cast("bigint").alias("duration_ms"),
        "status",
        F.substring(F.col("error").cast("string"), 1, ERROR_LENGTH).alias("error_message"),
        "started_at",
        "completed_at",
    )


def recent_runs(log: DataFrame, limit: int = 50) -> DataFrame:
    if not 1 <= limit <= MAX_RECENT:
        raise ValueError(f"limit must be between 1 and {MAX_RECENT}")
    return log.orderBy(F.desc("completed_at"), "run_id").limit(limit)


def latency_percentiles(requests: DataFrame) -> DataFrame:
    """Per path, the value at rank floor(n * p) of the sorted latencies, counting from zero."""
    counts = requests.groupBy("path", "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    ranks = {name: f"least(floor(total * {share}D), total - 1)" for name, share in PERCENTILES.items()}
    found = at_ranks(counts, ["path"], "latency_ms", "n", ranks)
    return found.select("path", *[F.round(name, 2).alias(name) for name in PERCENTILES], F.col("total").alias("count"))


def cache_hit_rate(requests: DataFrame) -> DataFrame:
    counts = requests.agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("requests"))
    return counts.withColumn("cache_hit_rate", F.round(guarded_ratio("hits", "requests"), 3))


def serving_metrics(requests: DataFrame, online_size: DataFrame) -> DataFrame:
    """`latency_percentiles` of every serving path, zeros for a silent one, and beside them the overall
    hit rate and the number of live online entities, the one row of `online_size`.

    Requests of other paths count for the hit rate only.
    """
    paths = requests.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, PATHS))).alias("path"))
    known = paths.join(latency_percentiles(requests), "path", "left").na.fill(0, [*PERCENTILES, "count"])
    # both sides are single rows
    both = cache_hit_rate(requests).select("cache_hit_rate").withColumn("_one", F.lit(1)).join(
        online_size.select(F.col("entities").alias("online_store_entities"), F.lit(1).alias("_one")), "_one"
    )
    return known.withColumn("_one", F.lit(1)).join(F.broadcast(both), "_one").drop("_one")
