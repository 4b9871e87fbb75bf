"""All registered queries and their oracle SQL."""

from __future__ import annotations

from logloom.plans import aggregates, catalogs, discovery, filters, ingests, streams, traces

_MODULES = (filters, aggregates, discovery, traces, catalogs, ingests, streams)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
