"""Queries by name, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query; ``views`` names the stand-in views that ``sql`` reads."""
    from .standins import VIEWS

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            head = ", ".join(f"{v} AS ({VIEWS[v]})" for v in views.split())
            body = sql.strip()
            if head:
                body = f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"
            ORACLE_SQL[name] = body
        return f

    return add
