"""Values and schemas that several test modules share; a module, so that no test imports from a conftest."""

from datetime import datetime

from tidemark.schemas import FEATURES

NOW = datetime(2024, 6, 1)


def history_ddl(extra: str = "") -> str:
    columns = ", ".join(f"{c} double" for c in FEATURES)
    return f"entity_id bigint, entity_type string, feature_version string, event_time timestamp_ntz, {columns}{extra}"
