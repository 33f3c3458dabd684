"""Query registry: key -> (DataFrame builder, oracle SQL or None).

A builder takes ``(spark, sf_dir)`` and returns a DataFrame. The oracle SQL is
written against the stand-in view names; ``with_views`` adds their CTEs so
DuckDB can run it on the raw parquet tables.
"""

from __future__ import annotations

from collections import OrderedDict

from rosterline.sources.standins import with_views

REGISTRY: "OrderedDict[str, tuple]" = OrderedDict()


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in REGISTRY:
            raise KeyError(f"query {key!r} registered twice")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def queries() -> dict:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict:
    return {k: with_views(v[1]) for k, v in REGISTRY.items() if v[1] is not None}
