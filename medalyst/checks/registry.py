"""Where queries and their oracle SQL are declared side by side."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

MODULES = ("io", "relational", "quality", "delivery", "silver", "customers", "subscribers", "contest",
           "registrations", "equipment", "statistics", "learning", "series", "streams")


class Tables:
    """Lazy parquet readers for one scale-factor folder. A file's footer is read for its schema once."""

    _schemas: dict[str, StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return wrap


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        import_module(f"medalyst.checks.{module}")
    return dict(_QUERIES), dict(_ORACLES)
