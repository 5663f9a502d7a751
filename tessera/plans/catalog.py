"""Registry of every query the engine exposes, with its reference SQL.

A registered query is a function ``(spark, sf_dir) -> DataFrame``.  The
gold model is rebuilt lazily per call, so every query runs over the whole
given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import BASE_CONF
from . import model, oracle
from . import queries as Q

Query = Callable[[SparkSession, str], DataFrame]


def _prepare(spark: SparkSession) -> None:
    # results depend on UTC dates; the rest makes plans adaptive
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)


# queries reading both silver users and silver tasks share one materialized
# aggregate (see model.gold_from_bronze)
_BOTH = {"q10_all_kpis", "q11_business_overview", "q12_user_productivity", "q13_users_without_tasks",
         "q14_top_productive_users", "q16_system_health", "q17_kpis"}


def _event_query(fn) -> Query:
    shared = fn.__name__ in _BOTH

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return fn(model.event_model(spark, sf_dir, shared=shared))
    run.__name__ = fn.__name__
    return run


def _state_query(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return fn(model.state_model(spark, sf_dir))
    run.__name__ = "orders_" + fn.__name__
    return run


_EXTRA: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Decorator for operator queries defined in other modules."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        _EXTRA[name] = (run, sql)
        return fn
    return deco


def _load_operator_queries() -> None:
    # importing the module registers its queries
    from . import increment_queries, operator_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _load_operator_queries()
    out: dict[str, Query] = {}
    for name, fn in Q.QUERIES.items():
        out[name] = _event_query(fn)
    for name in oracle.STATE_QUERIES:
        out["orders_" + name] = _state_query(Q.QUERIES[name])
    for name, (fn, _sql) in _EXTRA.items():
        out[name] = fn
    return out


def oracle_sql() -> dict[str, str]:
    _load_operator_queries()
    out: dict[str, str] = {}
    for name in Q.QUERIES:
        if name in oracle.QUERY_SQL:
            out[name] = oracle.event_query_sql(name)
    for name in oracle.STATE_QUERIES:
        out["orders_" + name] = oracle.state_query_sql(name)
    for name, (_fn, sql) in _EXTRA.items():
        if sql is not None:
            out[name] = sql
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return Q.q03_top_active_users(model.event_model(spark, sf_dir))
