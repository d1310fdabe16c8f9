"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from webcorpus.llm import queries as _queries


def queries() -> dict:
    return dict(_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_queries.SQL)
