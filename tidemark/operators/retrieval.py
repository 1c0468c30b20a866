"""Features for requested entities: from the online table, else computed from the raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import per_feature
from tidemark.operators import online as online_table
from tidemark.operators.features import feature_vector
from tidemark.operators.sizing import restrict_to_ids
from tidemark.operators.validation import validate
from tidemark.schemas import FEATURES, ONLINE_TTL_HOURS, VERSION
from tidemark.session import stage


def on_demand_single(
    users: DataFrame, transactions: DataFrame, tickets: DataFrame, entity_id: int, as_of: datetime,
    version: str = VERSION,
) -> DataFrame:
    """Features of one entity with their violations; the id reaches all three scans."""
    one = F.col("user_id") == entity_id
    return validate(feature_vector(users.where(one), transactions.where(one), tickets.where(one), as_of, version))


def on_demand_batch(
    users: DataFrame, transactions: DataFrame, tickets: DataFrame, ids: DataFrame, as_of: datetime,
    version: str = VERSION,
) -> DataFrame:
    """Features of the requested entities; an unknown id gives a row of NULLs.

    `violations` holds the broken rules of a row, so one bad entity leaves the others usable.
    """
    wanted = ids.select(F.col(ids.columns[0]).alias("user_id")).distinct()
    computed = feature_vector(
        *restrict_to_ids(wanted, "user_id", users, transactions, tickets), as_of, version
    )
    known = validate(computed).select("entity_id", *FEATURES, "violations")
    return wanted.withColumnRenamed("user_id", "entity_id").join(known, "entity_id", "left")


def dual_path_batch(
    online: DataFrame, users: DataFrame, transactions: DataFrame, tickets: DataFrame, ids: DataFrame,
    as_of: datetime, version: str = VERSION, ttl_hours: int = ONLINE_TTL_HOURS,
) -> DataFrame:
    """One row per requested id with its `source`: online_store, on_demand, invalid or not_found.

    The features of an invalid row, which breaks a rule, are withheld. The lookup is staged: its
    misses restrict three scans and decide how, and should not be looked up again each time.
    """
    found = stage(online_table.lookup(online, ids, as_of, version, ttl_hours), "lookup")
    hits = found.where("hit").select("entity_id", F.lit("online_store").alias("source"), *FEATURES)
    misses = found.where(~F.col("hit")).select("entity_id")
    computed = on_demand_batch(users, transactions, tickets, misses, as_of, version).selectExpr(
        "entity_id",
        "CASE WHEN violations IS NULL THEN 'not_found' WHEN size(violations) = 0 THEN 'on_demand'"
        " ELSE 'invalid' END AS source",
        *[f"CASE WHEN size(violations) = 0 THEN {c} END AS {c}" for c in FEATURES],
    )
    return hits.unionByName(computed)


def dual_path_summary(answers: DataFrame) -> DataFrame:
    """Misses count ids that were not online, whether or not they could be computed."""
    return answers.agg(
        F.count_if(F.col("source") == "online_store").alias("hits"),
        F.count_if(F.col("source") != "online_store").alias("misses"),
        F.count_if(F.col("source") == "on_demand").alias("on_demand_computed"),
    )


def parity_check(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """Per feature, how many entities differ between two feature sets of one moment."""
    left = stored.select("entity_id", F.struct(*FEATURES).alias("a"))
    right = computed.select("entity_id", F.struct(*FEATURES).alias("b"))
    both = left.join(right, "entity_id", "full")
    counts = both.agg(
        F.count(F.lit(1)).alias("n_entities"),
        *[F.expr(f"count_if(NOT a.{c} <=> b.{c})").alias(c) for c in FEATURES],
    )
    return per_feature(counts, FEATURES, {"n_different": "{}"}, "n_entities")
