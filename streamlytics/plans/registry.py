"""Name -> (query, equivalent SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamlytics.plans.views import VIEW_SQL
from streamlytics.session import size_shuffles, tune

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query. ``views`` names the SQL views its oracle selects from, in order."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            size_shuffles(tune(spark), sf_dir)
            return fn(spark, sf_dir.rstrip("/"))

        run.__name__ = name
        if name in _queries:
            raise ValueError(f"{name} is registered twice")
        _queries[name] = run
        if sql is not None:
            heads = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in views.split())
            _oracles[name] = f"WITH {heads}\n{sql}" if heads else sql
        return fn

    return register


def _load() -> None:
    from streamlytics.plans import (  # noqa: F401
        clicks, ingest, keyed, rows, streams, words, windows,
    )


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
