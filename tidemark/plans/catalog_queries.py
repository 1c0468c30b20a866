"""Registry and lineage next to the data they describe, run records and request records.

Definitions and declared edges are small and fixed; each query joins them with what the given
tables hold, so that its answer follows the data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import lineage, online, registry, run_log
from tidemark.operators.validation import validate
from tidemark.plans import fixtures as fx
from tidemark.plans import sql
from tidemark.schemas import FEATURE_REGISTRY, LINEAGE_EDGES, MATERIALIZATION_LOG, VERSION
from tidemark.session import new_path
from tidemark.sources import definitions, mapping, tables

DEFINED_AT, SYNCED_AT = datetime(1998, 1, 1), datetime(1998, 5, 1)
FEATURE = "txn_count_30d"
TAG = "risk"
RECENT = 10


def _coverage(spark, folder):
    return registry.coverage(fx.snapshot(spark, folder))


def registry_list(spark, folder):
    rows = registry.listing(definitions.registry_rows(spark, DEFINED_AT))
    described = rows.withColumn("tags", F.array_join("tags", ","))
    return described.join(_coverage(spark, folder), "feature_name").orderBy("feature_name")


def registry_names(spark, folder):
    names = registry.names(definitions.registry_rows(spark, DEFINED_AT))
    return names.join(_coverage(spark, folder).select("feature_name", "n_present"), "feature_name")


def registry_by_tag(spark, folder):
    rows = definitions.registry_rows(spark, DEFINED_AT)
    per_tag = registry.per_tag(rows).join(_coverage(spark, folder), "feature_name")
    tagged = registry.with_tag(rows, TAG).select("feature_name", F.lit(True).alias("risky"))
    return (
        per_tag.join(tagged, "feature_name", "left")
        .groupBy("tag")
        .agg(
            F.count(F.lit(1)).alias("n_features"),
            F.count_if(F.coalesce("risky", F.lit(False))).alias("n_risky"),
            F.sum("n_nonzero").alias("n_nonzero"),
        )
    )


def _synced(spark, rows_of, schema, label) -> DataFrame:
    """Two versions written, then one of them replaced; the other must stay as it was."""
    path = new_path(spark, label)
    for at, version in ((DEFINED_AT, VERSION), (DEFINED_AT, "v2"), (SYNCED_AT, VERSION)):
        tables.replace_version(path, rows_of(spark, at, version))
    return tables.read(spark, path, schema)


def registry_sync(spark, folder):
    stored = _synced(spark, definitions.registry_rows, FEATURE_REGISTRY, "registry")
    return stored.select("feature_name", "feature_version", "source_table", "created_at").join(
        _coverage(spark, folder), "feature_name"
    )


def _volumes(spark, folder) -> DataFrame:
    """Rows behind each lineage node: of a raw table, non-zero values of a feature, labels of a model."""
    users, transactions, tickets = mapping.raw(spark, folder)
    counted = [
        (lineage.RAW_TABLES[0], users), (lineage.RAW_TABLES[1], transactions), (lineage.RAW_TABLES[2], tickets),
        (definitions.MODEL, fx.churn(spark, folder)),
    ]
    volumes = _coverage(spark, folder).select(F.col("feature_name").alias("node"), F.col("n_nonzero").alias("n_rows"))
    for name, rows in counted:
        volumes = volumes.unionByName(rows.agg(F.lit(name).alias("node"), F.count(F.lit(1)).alias("n_rows")))
    return volumes


def _edges(spark) -> DataFrame:
    return definitions.lineage_rows(spark, DEFINED_AT)


def lineage_sync(spark, folder):
    stored = _synced(spark, definitions.lineage_rows, LINEAGE_EDGES, "lineage")
    sources = _volumes(spark, folder).withColumnRenamed("node", "source_node")
    return (
        stored.join(sources, "source_node")
        .groupBy("feature_version", "edge_type", "created_at")
        .agg(F.count(F.lit(1)).alias("n_edges"), F.sum("n_rows").alias("source_rows"))
    )


def _with_volumes(spark, folder, edges) -> DataFrame:
    volumes = _volumes(spark, folder)
    return edges.join(volumes.withColumnsRenamed({"node": "source_node", "n_rows": "source_rows"}), "source_node").join(
        volumes.withColumnsRenamed({"node": "target_node", "n_rows": "target_rows"}), "target_node"
    )


def lineage_edges(spark, folder):
    rows = _with_volumes(spark, folder, lineage.edges(_edges(spark)))
    columns = ["source_node", "target_node", "edge_type", "source_rows", "target_rows"]
    return rows.select(*columns).orderBy("edge_type", "source_node", "target_node")


def lineage_nodes(spark, folder):
    return lineage.nodes(lineage.edges(_edges(spark))).join(_volumes(spark, folder), "node")


def lineage_for_feature(spark, folder):
    return _with_volumes(spark, folder, lineage.for_feature(_edges(spark), FEATURE))


def lineage_siblings(spark, folder):
    volumes = _volumes(spark, folder).withColumnRenamed("node", "sibling")
    return lineage.siblings(_edges(spark), FEATURE).join(volumes, "sibling")


def lineage_reachability(spark, folder):
    return lineage.reachable(_edges(spark)).join(
        _volumes(spark, folder).withColumnsRenamed({"node": "start_node", "n_rows": "start_rows"}), "start_node"
    )


def lineage_subgraph(spark, folder):
    """Nodes around one feature with their rows: itself, upstream, downstream and siblings."""
    return lineage.subgraph(_edges(spark), FEATURE).join(_volumes(spark, folder), "node")


def lineage_nodes_for_feature(spark, folder):
    return lineage.nodes_for_feature(_edges(spark), FEATURE).join(_volumes(spark, folder), "node")


def _data_edges(spark, folder) -> DataFrame:
    """Which nations hold which segments, which segments order with which priorities, and how those orders ended."""
    customers, orders = mapping.table(spark, folder, "customer"), mapping.table(spark, folder, "orders")
    sold = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    hops = [
        customers.selectExpr("concat('nation:', c_nationkey) AS source_node", "concat('segment:', c_mktsegment) AS target_node"),
        sold.selectExpr("concat('segment:', c_mktsegment) AS source_node", "concat('priority:', o_orderpriority) AS target_node"),
        orders.selectExpr("concat('priority:', o_orderpriority) AS source_node", "concat('status:', o_orderstatus) AS target_node"),
    ]
    return hops[0].unionByName(hops[1]).unionByName(hops[2]).distinct()


def lineage_closure(spark, folder):
    """All paths of one to three edges through a graph made from the tables."""
    return lineage.closure(_data_edges(spark, folder))


def lineage_audit(spark, folder):
    """Features that vary in the training rows but are not declared as inputs of the model."""
    used = registry.coverage(fx.snapshot(spark, folder).join(
        fx.churn(spark, folder).select("entity_id"), "entity_id", "left_semi"
    )).where("n_nonzero > 0")
    return lineage.undeclared_inputs(_edges(spark), used)


def lineage_counts(spark, folder):
    """Nodes and edges of the part of the graph that holds rows at both ends."""
    rows = _with_volumes(spark, folder, lineage.edges(_edges(spark)))
    return lineage.counts(rows.where("source_rows > 0 AND target_rows > 0"))


def _runs(spark, folder) -> DataFrame:
    """One run per stored snapshot, as if each had been validated right when it was made."""
    checked = validate(fx.quarters(spark, folder))
    per_run = checked.groupBy("event_time").agg(
        F.expr("count_if(size(violations) = 0)").alias("processed"),
        F.expr("count_if(size(violations) > 0)").alias("entities_failed"),
    )
    return per_run.withColumns({
        "status": run_log.run_status(F.col("processed"), F.col("entities_failed")),
        "run_id": F.expr("concat('run-', date(event_time))"),
        "error": F.expr("CASE WHEN entities_failed > 0 THEN repeat('row held back; ', int(entities_failed)) END"),
        "started_at": F.col("event_time"),
        "completed_at": F.expr("event_time + make_dt_interval(0, 0, 0, entities_failed + 1.25)"),
    })


def _log(spark, folder) -> DataFrame:
    path = new_path(spark, "log")
    tables.append(path, run_log.run_records(_runs(spark, folder)))
    return tables.read(spark, path, MATERIALIZATION_LOG)


def run_log_all(spark, folder):
    return _log(spark, folder)


def run_log_recent(spark, folder):
    return run_log.recent_runs(_log(spark, folder), RECENT)


def latency_percentiles(spark, folder):
    return run_log.latency_percentiles(mapping.request_log(spark, folder))


def cache_hit_rate(spark, folder):
    return run_log.cache_hit_rate(mapping.request_log(spark, folder))


def serving_metrics(spark, folder):
    """Requests served before noon of any day, none of them in batches: a silent path still has its row."""
    requests = mapping.request_log(spark, folder).where("hour(ts) < 12 AND path <> 'batch'")
    return run_log.serving_metrics(requests, online.size(fx.online_table(spark, folder), fx.SNAPSHOT))


QUERIES = {
    "registry_list": registry_list,
    "registry_names": registry_names,
    "registry_by_tag": registry_by_tag,
    "registry_sync": registry_sync,
    "lineage_sync": lineage_sync,
    "lineage_edges": lineage_edges,
    "lineage_nodes": lineage_nodes,
    "lineage_for_feature": lineage_for_feature,
    "lineage_siblings": lineage_siblings,
    "lineage_reachability": lineage_reachability,
    "lineage_subgraph": lineage_subgraph,
    "lineage_nodes_for_feature": lineage_nodes_for_feature,
    "lineage_closure": lineage_closure,
    "lineage_audit": lineage_audit,
    "lineage_counts": lineage_counts,
    "run_log": run_log_all,
    "run_log_recent": run_log_recent,
    "latency_percentiles": latency_percentiles,
    "cache_hit_rate": cache_hit_rate,
    "serving_metrics": serving_metrics,
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rows(name: str, columns: str, rows: list[tuple[str, ...]]) -> str:
    values = ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {values})"


_REGISTRY = _rows(
    "registry",
    "feature_name, description, transformation, source_table, tags",
    [
        (f, *definitions.MEANING[f], definitions.SOURCE_AND_TAGS[f][0], ",".join(definitions.SOURCE_AND_TAGS[f][1]))
        for f in fx.FEATURES
    ],
)
_EDGES = _rows(
    "edges",
    "source_node, target_node, edge_type",
    [(definitions.SOURCE_AND_TAGS[f][0], f, "source") for f in fx.FEATURES]
    + [(f, definitions.MODEL, "model_input") for f in definitions.MODEL_INPUTS],
)
_COVERAGE = "coverage AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature_name, count(*) AS n_rows, count({c}) AS n_present, count(*) FILTER ({c} <> 0) AS n_nonzero"
    " FROM fv"
    for c in fx.FEATURES
) + ")"
_VOLUMES = f"""
volumes AS (
  SELECT feature_name AS node, n_nonzero AS n_rows FROM coverage
  UNION ALL SELECT 'raw_users', count(*) FROM raw_users
  UNION ALL SELECT 'raw_transactions', count(*) FROM raw_transactions
  UNION ALL SELECT 'raw_support_tickets', count(*) FROM raw_support_tickets
  UNION ALL SELECT '{definitions.MODEL}', count(*) FROM churn
)"""
_REG = sql.with_(fx.SNAPSHOT_SQL, _COVERAGE, _REGISTRY)
_LIN = sql.with_(fx.SNAPSHOT_SQL, _COVERAGE, fx.CHURN_SQL, _VOLUMES, _EDGES)
_WITH_VOLUMES = """
SELECT e.*, s.n_rows AS source_rows, t.n_rows AS target_rows
FROM edges e JOIN volumes s ON s.node = e.source_node JOIN volumes t ON t.node = e.target_node"""
_TYPE = (
    "CASE WHEN node LIKE 'raw\\_%' ESCAPE '\\' THEN 'raw_table' "
    "WHEN node LIKE 'churn\\_%' ESCAPE '\\' OR node LIKE '%\\_predictor%' ESCAPE '\\' THEN 'model' ELSE 'feature' END"
)
_LOG_SQL = """
runs AS (
  SELECT event_time, count(*) FILTER (violations = '') AS ok, count(*) FILTER (violations <> '') AS bad
  FROM checked GROUP BY event_time
),
log AS (
  SELECT 'run-' || CAST(CAST(event_time AS DATE) AS VARCHAR) AS run_id, 'v1' AS feature_version, 'user' AS entity_type,
         ok AS entities_processed, bad AS entities_failed, bad * 1000 + 1250 AS duration_ms,
         CASE WHEN bad = 0 THEN 'success' WHEN ok > 0 THEN 'partial' ELSE 'failed' END AS status,
         CASE WHEN bad > 0 THEN left(repeat('row held back; ', bad), 500) END AS error_message,
         event_time AS started_at, event_time + to_milliseconds(bad * 1000 + 1250) AS completed_at
  FROM runs
)"""
_WITH_LOG = sql.with_(fx.QUARTERS_SQL, sql.cleaned("checked", "h"), _LOG_SQL)

ORACLES = {
    "registry_list": _REG + f"""
SELECT r.feature_name, '{definitions.ENTITY_TYPE}' AS entity_type, '{definitions.DTYPE}' AS dtype, description,
       source_table, transformation, '{definitions.OWNER}' AS owner, tags, CAST(1 AS INTEGER) AS is_active,
       {sql.ts(DEFINED_AT)} AS created_at, 'v1' AS feature_version, n_rows, n_present, n_nonzero
FROM registry r JOIN coverage USING (feature_name) ORDER BY r.feature_name""",
    "registry_names": _REG + "SELECT feature_name, n_present FROM registry JOIN coverage USING (feature_name)",
    "registry_by_tag": _REG + f"""
SELECT tag, count(*) AS n_features, count(*) FILTER (list_contains(string_split(tags, ','), '{TAG}')) AS n_risky,
       CAST(sum(n_nonzero) AS BIGINT) AS n_nonzero
FROM (SELECT *, unnest(string_split(tags, ',')) AS tag FROM registry JOIN coverage USING (feature_name)) GROUP BY tag""",
    "registry_sync": _REG + f"""
SELECT r.feature_name, v AS feature_version, source_table, created_at, n_rows, n_present, n_nonzero
FROM registry r JOIN coverage USING (feature_name),
     (VALUES ('v1', {sql.ts(SYNCED_AT)}), ('v2', {sql.ts(DEFINED_AT)})) AS s(v, created_at)""",
    "lineage_sync": _LIN + f"""
SELECT v AS feature_version, edge_type, created_at, count(*) AS n_edges, CAST(sum(n_rows) AS BIGINT) AS source_rows
FROM edges JOIN volumes ON node = source_node,
     (VALUES ('v1', {sql.ts(SYNCED_AT)}), ('v2', {sql.ts(DEFINED_AT)})) AS s(v, created_at)
GROUP BY v, edge_type, created_at""",
    "lineage_edges": _LIN + _WITH_VOLUMES + " ORDER BY edge_type, source_node, target_node",
    "lineage_nodes": _LIN + f"""
SELECT node, {_TYPE} AS node_type, n_rows
FROM (SELECT source_node AS node FROM edges UNION SELECT target_node FROM edges) JOIN volumes USING (node)""",
    "lineage_for_feature": _LIN + f"""
SELECT *, CASE WHEN target_node = '{FEATURE}' THEN 'upstream' ELSE 'downstream' END AS direction
FROM ({_WITH_VOLUMES}) WHERE '{FEATURE}' IN (source_node, target_node)""",
    "lineage_siblings": _LIN + f"""
SELECT b.target_node AS sibling, b.source_node, n_rows
FROM edges a JOIN edges b ON a.source_node = b.source_node AND b.edge_type = 'source' AND b.target_node <> '{FEATURE}'
JOIN volumes ON node = b.target_node
WHERE a.target_node = '{FEATURE}' AND a.edge_type = 'source'""",
    "lineage_reachability": _LIN.rstrip() + """,
paths AS (
  SELECT source_node AS start_node, target_node AS at_node FROM edges WHERE source_node LIKE 'raw%'
  UNION ALL
  SELECT start_node, target_node FROM paths JOIN edges ON source_node = at_node
)
SELECT start_node, at_node AS end_node, count(*) AS n_paths, n_rows AS start_rows
FROM paths JOIN volumes ON node = start_node WHERE at_node LIKE 'churn%' GROUP BY start_node, at_node, n_rows""",
    "lineage_subgraph": _LIN.rstrip() + f""",
around AS (
  SELECT '{FEATURE}' AS node, 'itself' AS role, 0 AS distance
  UNION ALL SELECT source_node, 'upstream', 1 FROM edges WHERE target_node = '{FEATURE}'
  UNION ALL SELECT target_node, 'downstream', 1 FROM edges WHERE source_node = '{FEATURE}'
  UNION ALL SELECT DISTINCT b.target_node, 'sibling', 2
  FROM edges a JOIN edges b ON a.source_node = b.source_node AND b.edge_type = 'source' AND b.target_node <> '{FEATURE}'
  WHERE a.target_node = '{FEATURE}' AND a.edge_type = 'source'
)
SELECT node, {_TYPE} AS node_type, role, distance, n_rows FROM around JOIN volumes USING (node)""",
    "lineage_nodes_for_feature": _LIN + f"""
SELECT node, {_TYPE} AS node_type, n_rows
FROM (SELECT '{FEATURE}' AS node UNION SELECT source_node FROM edges WHERE target_node = '{FEATURE}'
      UNION SELECT target_node FROM edges WHERE source_node = '{FEATURE}') JOIN volumes USING (node)""",
    "lineage_closure": """
WITH RECURSIVE links AS (
  SELECT DISTINCT 'nation:' || c_nationkey AS source_node, 'segment:' || c_mktsegment AS target_node FROM customer
  UNION SELECT 'segment:' || c_mktsegment, 'priority:' || o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey
  UNION SELECT 'priority:' || o_orderpriority, 'status:' || o_orderstatus FROM orders
),
reach AS (
  SELECT source_node AS start_node, target_node AS node, 1 AS distance FROM links
  UNION ALL
  SELECT start_node, target_node, distance + 1 FROM reach JOIN links ON source_node = node
)
SELECT start_node, node, min(distance) AS distance, count(*) AS n_paths FROM reach GROUP BY start_node, node""",
    "lineage_audit": sql.with_(
        sql.RAW + "," + sql.snapshot("every", fx.SNAPSHOT), fx.CHURN_SQL,
        "fv AS (SELECT * FROM every WHERE entity_id IN (SELECT entity_id FROM churn))", _COVERAGE, _EDGES,
    ) + """SELECT * FROM coverage
WHERE n_nonzero > 0 AND feature_name NOT IN (SELECT source_node FROM edges WHERE edge_type = 'model_input')""",
    "lineage_counts": _LIN.rstrip() + f""",
live AS (SELECT * FROM ({_WITH_VOLUMES}) WHERE source_rows > 0 AND target_rows > 0)
SELECT (SELECT count(*) FROM (SELECT source_node FROM live UNION SELECT target_node FROM live)) AS node_count,
       (SELECT count(*) FROM live) AS edge_count""",
    "run_log": _WITH_LOG + "SELECT * FROM log",
    "run_log_recent": _WITH_LOG + f"SELECT * FROM log ORDER BY completed_at DESC, run_id LIMIT {RECENT}",
    "latency_percentiles": sql.with_(sql.REQUESTS) + """
SELECT path, round(s[CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT) + 1], 2) AS p50,
       round(s[CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1], 2) AS p95,
       round(s[least(CAST(floor(n * CAST(0.99 AS DOUBLE)) AS BIGINT), n - 1) + 1], 2) AS p99, n AS "count"
FROM (SELECT path, list(latency_ms ORDER BY latency_ms) AS s, count(*) AS n FROM request_log GROUP BY path)""",
    "serving_metrics": sql.with_(fx.ONLINE_SQL, sql.REQUESTS.removeprefix("WITH "), f"""
served AS (SELECT * FROM request_log WHERE hour(ts) < 12 AND path <> 'batch'),
per_path AS (
  SELECT path, round(s[CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT) + 1], 2) AS p50,
         round(s[CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1], 2) AS p95,
         round(s[least(CAST(floor(n * CAST(0.99 AS DOUBLE)) AS BIGINT), n - 1) + 1], 2) AS p99, n
  FROM (SELECT path, list(latency_ms ORDER BY latency_ms) AS s, count(*) AS n FROM served GROUP BY path)
)""") + f"""
SELECT p.path, coalesce(p50, 0) AS p50, coalesce(p95, 0) AS p95, coalesce(p99, 0) AS p99, coalesce(n, 0) AS "count",
       (SELECT round(count(*) FILTER (hit) / greatest(count(*), 1), 3) FROM served) AS cache_hit_rate,
       (SELECT count(*) FROM online WHERE written_at > {sql.ts(fx.SNAPSHOT)} - INTERVAL 48 HOUR) AS online_store_entities
FROM (VALUES ('online_store'), ('on_demand'), ('batch')) AS p(path) LEFT JOIN per_path USING (path)""",
    "cache_hit_rate": sql.with_(sql.REQUESTS) + """
SELECT count(*) FILTER (hit) AS hits, count(*) AS requests,
       round(count(*) FILTER (hit) / greatest(count(*), 1), 3) AS cache_hit_rate FROM request_log""",
}
