"""Names, Spark queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite.fixtures import Inputs, oracle
from watchfold.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, recipes: str = "", sql: str | None = None, stream: bool = False):
    """Registers a query over ``Inputs`` and, if given, the SQL it must agree with."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark, "watchfold", "suite")
            return build(Inputs(spark, sf_dir, stream))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(recipes, sql) if recipes else sql.strip()
        return build

    return register
