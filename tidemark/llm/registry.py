"""Registry of this subpackage's queries with the SQL of their results."""

from __future__ import annotations

QUERIES: dict = {}
EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            EXPECTED[name] = sql
        return run
    return register
