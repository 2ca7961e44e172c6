"""All registered queries of the survey operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

FLAGSHIP = "h14_election_summary"

_queries: dict[str, Callable] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with the SQL for the same rows."""

    def add(f: Callable) -> Callable:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable]:
    from . import cleaning_queries, import_queries, run_queries, serving_queries, text_queries, validation_queries  # noqa: F401

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_sql)
