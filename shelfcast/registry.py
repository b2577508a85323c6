"""Registry of named queries: key -> (Spark callable(spark, sf_dir), DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    fn: QueryFn
    sql: str | None
    ids: str  # SURVEY operator ids covered


_REGISTRY: dict[str, Entry] = {}


def register(key: str, sql: str | None = None, ids: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        _REGISTRY[key] = Entry(key, fn, sql, ids)
        return fn

    return deco


def load_all() -> dict[str, Entry]:
    import shelfcast.catalog  # noqa: F401  (imports every catalog module)

    return dict(_REGISTRY)
