"""Compose a source, transforms and a sink; also from a configuration.

The plan stays lazy: the only action is the write at the end, plus any a check asks for.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemill.errors import ConfigError, FlowError
from tidemill.operators.rows import rename, where_equals
from tidemill.sinks.files import save_csv
from tidemill.sinks.tables import save_database, save_table
from tidemill.sources.tables import read_source

log = logging.getLogger(__name__)

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Step:
    """A transform with optional checks of what goes in and comes out; checks raise to stop the flow."""

    transform: Transform
    validate_input: Callable[[DataFrame], Any] | None = None
    validate_output: Callable[[DataFrame], Any] | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.validate_input:
            self.validate_input(df)
        result = self.transform(df)
        if self.validate_output:
            self.validate_output(result)
        return result


@dataclass(frozen=True)
class Flow:
    name: str
    extract: Callable[[], DataFrame]
    steps: Sequence[Transform | Step] = ()
    load: Callable[[DataFrame], Any] | None = None
    validate_source: Callable[[], bool] = field(default=lambda: True)
    validate_target: Callable[[], bool] = field(default=lambda: True)

    def run(self) -> DataFrame:
        """Extract, transform and load; returns the transformed frame even if it was loaded."""
        try:
            if not self.validate_source():
                raise FlowError(f"the source of '{self.name}' is invalid")
            df = self.extract()
            for step in self.steps:
                df = step(df)
            if self.load:
                if not self.validate_target():
                    raise FlowError(f"the target of '{self.name}' is invalid")
                self.load(df)
            return df
        except FlowError:
            raise
        except Exception as error:
            raise FlowError(f"flow '{self.name}' failed: {error}") from error


def replace_load(
    df: DataFrame, table: str = "raw_data.ingested_data", max_attempts: int = 3, delay: float = 2.0
) -> int:
    """Replace a table by the frame, with a few attempts against passing driver-side errors.

    An incremental scan loaded this way leaves only its new rows in the table; to keep the old ones
    use ``save_table(..., "append")`` or an upsert.
    """
    for attempt in range(1, max_attempts + 1):
        try:
            return save_table(df, table, "replace")
        except Exception as error:
            log.error("load failed on attempt %d: %s", attempt, error)
            if attempt == max_attempts:
                raise
            time.sleep(delay)
    raise ValueError("max_attempts must be at least 1")


def _filter(config: Mapping[str, Any]) -> Transform:
    return lambda df: where_equals(df, config["field"], config["value"])


def _rename(config: Mapping[str, Any]) -> Transform:
    return lambda df: rename(df, config["mappings"])


TRANSFORMERS: dict[str, Callable[[Mapping[str, Any]], Transform]] = {"filter": _filter, "rename": _rename}


def _write_database(df: DataFrame, config: Mapping[str, Any]) -> int:
    mode = config.get("mode", "append")
    if "connection_string" in config:
        return save_database(df, config["connection_string"], config["table"], mode)
    return save_table(df, config["table"], mode)


def _write_file(df: DataFrame, config: Mapping[str, Any]) -> int:
    return save_csv(df, config["file_path"], config.get("mode", "append"))


LOADERS: dict[str, Callable[[DataFrame, Mapping[str, Any]], int]] = {
    "database": _write_database,
    "file": _write_file,
}


def _part(config: Mapping[str, Any], what: str, known: Mapping[str, Any]) -> tuple[Any, Mapping[str, Any]]:
    kind = config.get("type")
    if kind not in known:
        raise ConfigError(f"unknown {what} {kind!r}, expected one of {', '.join(known)}")
    return known[kind], config.get("config", {})


def flow_from_config(spark: SparkSession, config: Mapping[str, Any]) -> Flow:
    """Build a flow from a mapping.

    ``extractor`` has ``type`` (csv, json, parquet, postgres, api) and the reader's ``config``;
    ``transformers`` is a list of ``{"type": "filter", "config": {"field", "value"}}`` and
    ``{"type": "rename", "config": {"mappings"}}``; ``loader`` is ``database`` or ``file``.
    """
    source = config.get("extractor")
    if not source:
        raise ConfigError("a flow starts with an extractor, and none is given")
    steps = []
    for entry in config.get("transformers", ()):
        build, settings = _part(entry, "transformer", TRANSFORMERS)
        steps.append(build(settings))
    load = None
    if config.get("loader"):
        write, settings = _part(config["loader"], "loader", LOADERS)
        load = lambda df: write(df, settings)
    return Flow(
        name=config.get("name", "flow"),
        extract=lambda: read_source(spark, source.get("type"), **source.get("config", {})),
        steps=steps,
        load=load,
    )
