"""Collects the queries of the sibling modules."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ["events", "marts", "changes", "usage", "landing"]


class Tables:
    """The given tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self._folder = folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.once(name, lambda: self.spark.read.parquet(f"{self._folder}/{name}.parquet"))

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A frame that several parts of a query start from: planned once, still lazy."""
        if name not in self._made:
            self._made[name] = build()
        return self._made[name]


def query(
    sql: str | None = None, name: str | None = None
) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables, by default under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        _QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            _ORACLES[key] = sql
        return build

    return register


def _load() -> None:
    for module in _MODULES:
        import_module(f"{__package__}.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
