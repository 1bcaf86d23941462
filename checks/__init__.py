"""Registered queries over the given tables, each with the SQL that states its expected result."""

from checks import forge, glucose, layers, movement, quality, retail, whole

_GROUPS = (retail, quality, glucose, forge, movement, layers, whole)

QUERIES = {name: build for group in _GROUPS for name, build in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
