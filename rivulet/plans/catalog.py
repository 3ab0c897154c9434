"""Registry: query name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None


_REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Decorator registering ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def wrap(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, sql)
        return fn
    return wrap


def _load() -> None:
    # Import for the registration side effect.
    from rivulet.plans import relational, events, graphs, learning, files  # noqa: F401


def entries() -> dict[str, Entry]:
    _load()
    return dict(_REGISTRY)
