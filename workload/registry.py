"""Named queries over the test tables, each with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.bindings import Bindings
from workload.oracle_views import over_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BUILDERS: dict[str, Callable[[Bindings], DataFrame]] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Bindings` under a name."""

    def register(build: Callable[[Bindings], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Bindings(spark, sf_dir))

        QUERIES[name] = run
        BUILDERS[name] = build
        if sql is not None:
            ORACLES[name] = over_views(sql)
        return build

    return register
