"""The table of named queries: a Spark callable and, where one exists, the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from leadloom.catalog.bindings import view, with_views
from leadloom.functions.scalars import rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Source:
    """The tables and views of one scale factor."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of a :class:`Source`. DOUBLE columns are rounded to 6 digits on both sides."""

    def register(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(build(Source(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
