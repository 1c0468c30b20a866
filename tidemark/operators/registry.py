"""Reading the feature registry, alone and next to the stored features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import missing_sql, per_feature
from tidemark.schemas import FEATURES, VERSION


def active(registry: DataFrame, version: str = VERSION) -> DataFrame:
    return registry.where((F.col("is_active") == 1) & (F.col("feature_version") == version))


def listing(registry: DataFrame, version: str = VERSION) -> DataFrame:
    return active(registry, version).drop("deprecated_at").orderBy("feature_name")


def names(registry: DataFrame, version: str = VERSION) -> DataFrame:
    return active(registry, version).select("feature_name")


def with_tag(registry: DataFrame, tag: str, version: str = VERSION) -> DataFrame:
    return active(registry, version).where(F.array_contains("tags", tag))


def per_tag(registry: DataFrame, version: str = VERSION) -> DataFrame:
    return active(registry, version).select("feature_name", F.explode("tags").alias("tag"))


def coverage(features: DataFrame) -> DataFrame:
    """Per feature: rows, present values and non-zero values, from one pass over the features."""
    counts = features.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.expr(f"count_if(NOT {missing_sql(c)})").alias(f"p_{c}") for c in FEATURES],
        *[F.expr(f"count_if(NOT {missing_sql(c)} AND {c} <> 0)").alias(f"z_{c}") for c in FEATURES],
    )
    return per_feature(counts, FEATURES, {"n_present": "p_{}", "n_nonzero": "z_{}"}, "n_rows")
