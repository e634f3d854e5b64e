"""Named queries: a Spark plan over bound tables and, where one exists, the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkmart.sources.bindings import bind, with_clause


class Tables:
    """Bound tables of one data folder, e.g. ``t.finance``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            self._known[name] = bind(self.spark, self.folder, name)
        return self._known[name]


@dataclass(frozen=True)
class Query:
    plan: Callable[[Tables], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(Tables(spark, folder))


class Registry:
    """Queries of one area, with SQL fragments their oracles share."""

    def __init__(self, fragments: dict[str, str] | None = None):
        self.fragments = dict(fragments or {})
        self.queries: dict[str, Query] = {}

    def add(self, name: str, plan: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")
        self.queries[name] = Query(plan, with_clause(sql, self.fragments) if sql else None)
