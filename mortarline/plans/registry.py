"""All queries of the core and their DuckDB counterparts."""

from __future__ import annotations

from mortarline.plans import analytic_queries, extract_queries, features_queries, score_queries, text_queries

MODULES = [features_queries, text_queries, score_queries, analytic_queries, extract_queries]


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
