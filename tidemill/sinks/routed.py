"""Sinks that derive their target from the kind of entity."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill.sinks.files import save_json
from tidemill.sinks.tables import save_table

# Target names of endpoints whose name differs from the endpoint's.
TARGET_NAMES = {"pulls": "pull_requests"}
TABLE_PREFIX = "github"


def target_name(endpoint: str) -> str:
    return TARGET_NAMES.get(endpoint, endpoint)


def target_table(endpoint: str = "issues") -> str:
    return f"{TABLE_PREFIX}_{target_name(endpoint)}"


def target_path(entity_type: str = "repo", endpoint: str = "issues", root: str = "data") -> str:
    return f"{root}/{TABLE_PREFIX}/{entity_type}/{target_name(endpoint)}.json"


def load_entity_table(df: DataFrame, endpoint: str, schema: str = "default", if_exists: str = "append") -> int:
    """Write to the endpoint's table; returns the rows loaded."""
    return save_table(df, [schema, target_table(endpoint)], if_exists)


def load_entity_file(df: DataFrame, entity_type: str, endpoint: str, root: str = "data") -> int:
    """Write to the endpoint's JSON folder; returns the rows written."""
    return save_json(df, target_path(entity_type, endpoint, root))
