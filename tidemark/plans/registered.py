"""All registered queries and their SQL."""

from __future__ import annotations

from tidemark.plans import catalog_queries, drift_queries, feature_queries, history_queries, serving_queries, training_queries

_PARTS = (feature_queries, history_queries, serving_queries, training_queries, drift_queries, catalog_queries)
QUERIES = {key: query for part in _PARTS for key, query in part.QUERIES.items()}
ORACLES = {key: text for part in _PARTS for key, text in part.ORACLES.items()}
