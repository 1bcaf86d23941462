"""CSV and JSON folders."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from tidemill.sinks.tables import counted, write_mode


CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def save_csv(df: DataFrame, path: str, if_exists: str = "replace", **options: Any) -> int:
    """CSV with header; blanks are kept and no index column is added."""
    rows, seen = counted(df)
    rows.write.mode(write_mode(if_exists)).options(**{**CSV_OPTIONS, **options}).csv(path)
    return seen.get["rows"]


def save_json(df: DataFrame, path: str, if_exists: str = "replace", **options: Any) -> int:
    """One JSON object per line, nulls kept."""
    rows, seen = counted(df)
    rows.write.mode(write_mode(if_exists)).options(**{"ignoreNullFields": False, **options}).json(path)
    return seen.get["rows"]
