"""Queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import barcode_queries, format_queries, front_queries, genome_queries, read_queries, record_queries

_ALL = barcode_queries.QUERIES | format_queries.QUERIES | front_queries.QUERIES | genome_queries.QUERIES | read_queries.QUERIES | record_queries.QUERIES
QUERIES = {k: f for k, (f, _) in _ALL.items()}
ORACLE: dict[str, str] = {k: sql for k, (_, sql) in _ALL.items() if sql}
