"""Name -> query and name -> oracle SQL registries."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "kestrel.plans.q_profile",
    "kestrel.plans.q_clean",
    "kestrel.plans.q_features",
    "kestrel.plans.q_encode",
    "kestrel.plans.q_sampling",
    "kestrel.plans.q_metrics",
    "kestrel.plans.q_leaderboard",
    "kestrel.plans.q_models",
)


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
