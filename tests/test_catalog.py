from datetime import datetime, timedelta

import pytest
from raw_data import NOW

from tidemark.operators import lineage, registry, run_log
from tidemark.schemas import FEATURE_REGISTRY, FEATURES, MATERIALIZATION_LOG, REQUEST_LOG, TABLES
from tidemark.session import new_path
from tidemark.sources import definitions, tables


def test_absent_tables_read_as_empty(spark):
    for name, schema in TABLES.items():
        table = tables.read_table(spark, new_path(spark, "none"), name)
        assert table.isEmpty() and len(table.columns) == len(schema.split(", "))


def test_registry(spark):
    rows = definitions.registry_rows(spark, NOW)
    assert [r.feature_name for r in registry.names(rows).collect()] == FEATURES
    listed = [r.feature_name for r in registry.listing(rows).collect()]
    assert listed == sorted(FEATURES)
    assert {r.feature_name for r in registry.with_tag(rows, "risk").collect()} == {"failed_txn_rate_30d", "open_tickets"}
    assert registry.active(rows.selectExpr("* EXCEPT (is_active)", "0 AS is_active")).isEmpty()
    assert registry.active(rows, "v2").isEmpty()


def test_replacing_one_version_leaves_the_other(spark):
    path = new_path(spark, "registry")
    rows = definitions.registry_rows(spark, NOW)
    tables.replace_version(path, rows)
    tables.replace_version(path, definitions.registry_rows(spark, NOW, "v2"))
    for _ in range(2):
        tables.replace_version(path, rows.limit(5))
    stored = tables.read(spark, path, FEATURE_REGISTRY)
    assert {(r.feature_version, r["count"]) for r in stored.groupBy("feature_version").count().collect()} == {("v1", 5), ("v2", 13)}


def test_lineage(spark):
    rows = definitions.lineage_rows(spark, NOW)
    edges = lineage.edges(rows)
    assert lineage.counts(edges).first().asDict() == {"node_count": 17, "edge_count": 22}
    types = {r.node: r.node_type for r in lineage.nodes(edges).collect()}
    assert types["raw_users"] == "raw_table" and types["churn_predictor_v1"] == "model" and types["open_tickets"] == "feature"
    around = {(r.source_node, r.target_node, r.direction) for r in lineage.for_feature(rows, "open_tickets").collect()}
    assert around == {
        ("raw_support_tickets", "open_tickets", "upstream"), ("open_tickets", "churn_predictor_v1", "downstream")
    }
    alone = lineage.nodes_for_feature(rows, "unknown_feature").collect()
    assert [(r.node, r.node_type) for r in alone] == [("unknown_feature", "feature")]
    assert [r.sibling for r in lineage.siblings(rows, "plan_encoded").collect()] == ["account_age_days"]
    paths = {r.start_node: r.n_paths for r in lineage.reachable(rows).collect()}
    assert paths == {"raw_transactions": 5, "raw_support_tickets": 2, "raw_users": 2}
    used = registry.names(definitions.registry_rows(spark, NOW))
    missing = {r.feature_name for r in lineage.undeclared_inputs(rows, used).collect()}
    assert missing == {"txn_count_7d", "txn_count_90d", "total_spend_7d", "total_spend_90d"}


def test_run_log(spark):
    path = new_path(spark, "log")
    runs = [(f"r{i}", i, 0, "success", "x" * 600 if i == 2 else None, NOW, NOW + timedelta(milliseconds=i)) for i in range(5)]
    frame = spark.createDataFrame(
        runs,
        "run_id string, processed bigint, entities_failed bigint, status string, error string, "
        "started_at timestamp_ntz, completed_at timestamp_ntz",
    )
    tables.append(path, run_log.run_records(frame))
    log = tables.read(spark, path, MATERIALIZATION_LOG)
    recent = run_log.recent_runs(log, 3).collect()
    assert [(r.run_id, r.duration_ms) for r in recent] == [("r4", 4), ("r3", 3), ("r2", 2)]
    assert len(recent[2].error_message) == 500
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            run_log.recent_runs(log, limit)


def test_latency(spark):
    values = {"online_store": [5.0, 1.0, 3.0, 2.0], "batch": [9.0], "on_demand": [float(i) for i in range(200)]}
    rows = [(path, v, path != "on_demand", datetime(2024, 1, 1)) for path, vs in values.items() for v in vs]
    requests = spark.createDataFrame(rows, REQUEST_LOG)
    got = {r.path: r for r in run_log.latency_percentiles(requests).collect()}
    for path, vs in values.items():
        s, n = sorted(vs), len(vs)
        assert (got[path].p50, got[path].p95, got[path].p99, got[path]["count"]) == (
            s[int(n * 0.5)], s[int(n * 0.95)], s[min(int(n * 0.99), n - 1)], n
        )
    assert run_log.cache_hit_rate(requests).first().cache_hit_rate == round(5 / 205, 3)
    assert run_log.cache_hit_rate(requests.limit(0)).first().cache_hit_rate == 0.0
