"""Sets of SQL models that refer to each other."""

from __future__ import annotations

import re
from collections.abc import Mapping
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import SparkSession

from tidemill.errors import ConfigError
from tidemill.sinks.tables import materialize

_RELATION = re.compile(r"'?UnresolvedRelation \[([^\]]+)\]")
_LOCAL = re.compile(r"CTE \[([^\]]+)\]")


def references(spark: SparkSession, query: str) -> set[str]:
    """The relations that a query reads, subqueries included, as Spark's own parser finds them; its own WITH names are left out."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query).toString()
    local = {name.strip().lower() for names in _LOCAL.findall(plan) for name in names.split(",")}
    found = {".".join(part.strip() for part in names.split(",")).lower() for names in _RELATION.findall(plan)}
    return found - local


def build_order(spark: SparkSession, models: Mapping[str, str]) -> list[str]:
    """The models in an order in which each comes after those it reads; a cycle is an error."""
    names = {name.lower(): name for name in models}
    graph = {name: {names[r] for r in references(spark, sql) if r in names} for name, sql in models.items()}
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as error:
        raise ConfigError(f"models refer to each other in a circle: {' -> '.join(error.args[1])}") from error


def build_models(spark: SparkSession, models: Mapping[str, str], tables: set[str] = frozenset(), full_refresh: bool = True) -> list[str]:
    """Build a set of models given in any order, those in ``tables`` as tables and others as views; returns the order.

    Names are those used in the queries. Nothing is built when there is a cycle.
    """
    order = build_order(spark, models)
    for name in order:
        materialize(spark, name, models[name], "table" if name in tables else "view", full_refresh)
    return order
