"""The queries of the annotation operators and their DuckDB SQL."""

from __future__ import annotations

from annospark.queries import evaluation, geometry, records, sources, stats, streams, validation, work

_MODULES = (geometry, stats, validation, records, evaluation, work, streams, sources)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
