"""How a query is declared: a function of the views and the expected SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bannerloom.plans.views import Views


@dataclass(frozen=True)
class Query:
    build: Callable[[Views], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Views(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = Query(build, sql)
        return build

    return register
