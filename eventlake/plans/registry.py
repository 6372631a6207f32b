"""Queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

from eventlake.plans import event_queries, file_queries, growth_queries, manifest_queries, stream_queries, text_queries, version_queries

MODULES = (event_queries, file_queries, growth_queries, manifest_queries, stream_queries, text_queries, version_queries)
QUERIES = {name: run for module in MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
