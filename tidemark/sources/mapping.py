"""Shape the given order tables as users, transactions, tickets and request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def users(spark: SparkSession, folder: str) -> DataFrame:
    """One user per customer; the first order is the sign-up, the market segment the plan."""
    first_order = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    return (
        table(spark, folder, "customer")
        .join(first_order, "c_custkey", "left")
        .selectExpr(
            "c_custkey AS user_id",
            "to_date(first_order) AS signup_date",
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'free' WHEN 'BUILDING' THEN 'basic'"
            " WHEN 'FURNITURE' THEN 'pro' ELSE 'enterprise' END AS plan_type",
        )
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per order."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS transaction_id",
        "o_custkey AS user_id",
        "o_totalprice AS amount",
        "o_orderpriority AS category",
        "CASE WHEN o_orderstatus <> 'P' THEN 'success' WHEN o_orderpriority = '5-LOW' THEN 'refunded'"
        " ELSE 'failed' END AS status",
        "o_orderdate AS event_time",
    )


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """One ticket per returned line, opened at the ship date."""
    owner = table(spark, folder, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    return returned.join(owner, "l_orderkey").selectExpr(
        "l_orderkey * 10 + l_linenumber AS ticket_id",
        "o_custkey AS user_id",
        "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS resolved",
        "l_shipdate AS event_time",
    )


def raw(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return users(spark, folder), transactions(spark, folder), tickets(spark, folder)


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """One served request per event."""
    return table(spark, folder, "events").selectExpr(
        "CASE WHEN event_type IN ('click', 'signup') THEN 'online_store'"
        " WHEN event_type = 'purchase' THEN 'batch' ELSE 'on_demand' END AS path",
        "value AS latency_ms",
        "event_type <> 'error' AS hit",
        "ts",
    )
