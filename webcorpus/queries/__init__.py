"""Registered queries, each with the SQL that states its expected result."""

from webcorpus.queries import documents, indexes, listing, scanning, values

_MODULES = (listing, scanning, values, documents, indexes)


def queries() -> dict:
    return {name: q for module in _MODULES for name, (q, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql}
