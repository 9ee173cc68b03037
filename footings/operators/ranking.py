"""Orders, limits and sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.operators.windows import first_ranked


def ranked(df: DataFrame, value: str, ties: list[str]) -> DataFrame:
    """Global order by value, largest first, a missing value as zero; a distributed range sort."""
    return df.orderBy(F.coalesce(F.col(value), F.lit(0.0)).desc(), *ties)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows over all: each task keeps k, so no global sort is needed."""
    return df.orderBy(*order).limit(k)


def sample_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group as examples."""
    return first_ranked(df, keys, order, k)


def order_last(df: DataFrame, col: str, sentinel: str) -> DataFrame:
    """By name, with the sentinel last."""
    return df.orderBy(F.col(col) == sentinel, col)


def arg_extreme(df: DataFrame, keys: list[str], value: str, ordinal: str, columns: list[str], largest: bool = False) -> DataFrame:
    """Per key the row with the smallest (or largest) value; the first row wins ties."""
    sign = -F.col(value) if largest else F.col(value)
    best = F.min(F.when(F.col(value).isNotNull(), F.struct(sign.alias("_s"), F.col(ordinal), *columns, F.col(value).alias("_v"))))
    names = list(dict.fromkeys([ordinal, *columns]))
    return df.groupBy(*keys).agg(best.alias("_b")).select(
        *keys, F.col("_b")["_v"].alias(value), *[F.col("_b")[c].alias(c) for c in names])


def merge_facts(frames: list[DataFrame]) -> DataFrame:
    """Stage outputs into one table; a frame with another schema fails."""
    return reduce(DataFrame.unionByName, frames)


def keys_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys on both sides."""
    return a.intersect(b)


def keys_only(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys of the first side that the other lacks."""
    return a.subtract(b)


def append_scenario(fact: DataFrame, new: DataFrame, grain: list[str]) -> tuple[DataFrame, DataFrame]:
    """(all rows, collisions): rows are added, never replaced; a grain held twice is reported."""
    both = fact.unionByName(new)
    return both, both.groupBy(*grain).agg(F.count("*").alias("rows")).filter("rows > 1")
