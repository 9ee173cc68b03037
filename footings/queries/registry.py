"""Registry of demonstration queries, each beside its independent SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


class Tables:
    """Lazy access to the parquet tables of one directory: `t.orders`, `t.part`, …"""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`, with the SQL that must agree."""

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn

    return wrap


def runnable(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """The driver's calling convention for a registered query."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(Tables(spark, sf_dir))

    return run
