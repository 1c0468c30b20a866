"""Lineage as an edge list: source tables to features to models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import VERSION

# The raw tables, and how a model's name is told apart.
RAW_TABLES = ["raw_users", "raw_transactions", "raw_support_tickets"]
MODEL_PREFIX = "churn_"
MODEL_PART = "_predictor"


def edges(lineage: DataFrame, version: str = VERSION) -> DataFrame:
    return (
        lineage.where(F.col("feature_version") == version)
        .select("source_node", "target_node", "edge_type")
        .orderBy("edge_type", "source_node")
    )


def node_type(node: Column) -> Column:
    return (
        F.when(node.isin(RAW_TABLES), "raw_table")
        .when(node.startswith(MODEL_PREFIX) | node.contains(MODEL_PART), "model")
        .otherwise("feature")
    )


def nodes(edge_list: DataFrame) -> DataFrame:
    ends = edge_list.select(F.col("source_node").alias("node")).union(edge_list.select("target_node")).distinct()
    return ends.withColumn("node_type", node_type(F.col("node")))


def for_feature(lineage: DataFrame, feature: str, version: str = VERSION) -> DataFrame:
    """Edges into the feature and out of it; a feature that feeds itself counts on both sides."""
    all_edges = edges(lineage, version)
    upstream = all_edges.where(F.col("target_node") == feature).withColumn("direction", F.lit("upstream"))
    downstream = all_edges.where(F.col("source_node") == feature).withColumn("direction", F.lit("downstream"))
    return upstream.unionByName(downstream)


def nodes_for_feature(lineage: DataFrame, feature: str, version: str = VERSION) -> DataFrame:
    """The feature with its neighbours; the feature is there even without any edge."""
    itself = lineage.sparkSession.range(1).select(F.lit(feature).alias("node"))
    around = nodes(for_feature(lineage, feature, version)).select("node")
    return around.union(itself).distinct().withColumn("node_type", node_type(F.col("node")))


def siblings(lineage: DataFrame, feature: str, version: str = VERSION) -> DataFrame:
    """Other features that share a source with the feature."""
    sourced = edges(lineage, version).where(F.col("edge_type") == "source")
    own = sourced.where(F.col("target_node") == feature).select("source_node")
    return (
        sourced.join(own, "source_node", "left_semi")
        .where(F.col("target_node") != feature)
        .select("source_node", F.col("target_node").alias("sibling"))
    )


_CLOSURE = """
WITH RECURSIVE reach (start_node, node, path) AS (
  SELECT source_node, target_node, array(source_node, target_node) FROM {links} WHERE {start} AND source_node <> target_node
  UNION ALL
  SELECT start_node, target_node, concat(path, array(target_node))
  FROM reach JOIN {links} ON source_node = node
  WHERE NOT array_contains(path, target_node)
)
SELECT start_node, node, min(size(path) - 1) AS distance, count(1) AS n_paths FROM reach GROUP BY start_node, node
"""


def closure(edge_list: DataFrame, start: str = "true") -> DataFrame:
    """(start_node, node, distance, n_paths): every node that a path leads to, over any number of edges.

    `start` is SQL on source_node that chooses where paths begin. A path visits no node twice, so cycles
    end; `distance` is the number of edges of the shortest path and `n_paths` counts all of them.
    Lineage is metadata, a graph of declared names; Spark's limits on recursion (100 levels, and its
    number of rows) raise an error rather than leave paths out.
    """
    links = edge_list.select("source_node", "target_node").where("source_node IS NOT NULL AND target_node IS NOT NULL").distinct()
    return edge_list.sparkSession.sql(_CLOSURE.replace("{start}", start), links=links)


def reachable(lineage: DataFrame, start_type: str = "raw_table", end_type: str = "model", version: str = VERSION) -> DataFrame:
    """Pairs (start_node, end_node) of the two types that a path of any length joins, with the number of such paths."""
    found = closure(edges(lineage, version))
    ends = (node_type(F.col("start_node")) == start_type) & (node_type(F.col("node")) == end_type)
    return found.where(ends).select("start_node", F.col("node").alias("end_node"), "n_paths")


def subgraph(lineage: DataFrame, feature: str, version: str = VERSION) -> DataFrame:
    """(node, node_type, role, distance): the feature itself, all it comes from (upstream) and leads to
    (downstream) over any number of edges, and its siblings, which share a direct source with it.

    The feature is there even without any edge. A node of a cycle through the feature has both roles.
    """
    declared = edges(lineage, version)
    links = declared.select("source_node", "target_node")
    turned = links.select(F.col("target_node").alias("source_node"), F.col("source_node").alias("target_node"))
    name = "'" + feature.replace("\\", "\\\\").replace("'", "\\'") + "'"
    around = declared.sparkSession.range(1).select(F.lit(feature).alias("node"), F.lit("itself").alias("role"), F.lit(0).alias("distance"))
    for role, graph in (("upstream", turned), ("downstream", links)):
        found = closure(graph, f"source_node = {name}")
        around = around.unionByName(found.select("node", F.lit(role).alias("role"), "distance"))
    near = siblings(lineage, feature, version).select(F.col("sibling").alias("node"), F.lit("sibling").alias("role"), F.lit(2).alias("distance"))
    return around.unionByName(near.distinct()).select("node", node_type(F.col("node")).alias("node_type"), "role", "distance")


def undeclared_inputs(lineage: DataFrame, used: DataFrame, version: str = VERSION) -> DataFrame:
    """Features a model is trained on (`feature_name`) without a declared edge to a model."""
    declared = edges(lineage, version).where(F.col("edge_type") == "model_input")
    return used.join(declared, used.feature_name == declared.source_node, "left_anti")


def counts(edge_list: DataFrame) -> DataFrame:
    """Number of nodes and edges; each edge contributes its two ends and counts once."""
    ends = edge_list.select(F.explode(F.array("source_node", "target_node")).alias("node"), F.lit(1).alias("half"))
    return ends.agg(
        F.count_distinct("node").alias("node_count"), (F.sum("half") / 2).cast("bigint").alias("edge_count")
    )
