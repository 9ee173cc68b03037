"""Joins with few, very frequent keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

SALTS = 64   # fixed value: tasks that one key is spread over
FREQUENT = 1000   # fixed value: a key with more than one of so many rows is spread, so fewer than this many are


def _salt(df: DataFrame) -> Column:
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, MapType)]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(SALTS))


def salted_join(df: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join with a table of few rows per key where most rows of `df` may share one key.

    Every key is spread over a fixed number of salts, and `small` is repeated for each, so
    no task reads a whole key.
    """
    spread = df.withColumn("_salt", _salt(df))
    copies = small.withColumn("_salt", F.explode(_salts()))
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def salted_join_many(df: DataFrame, many: DataFrame, keys: list[str], how: str) -> DataFrame:
    """The same join with a table of many keys: only rows of frequent keys are spread, and only those keys repeated.

    Repeating the whole table for each salt would make it larger than `df` itself.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    # At most FREQUENT keys hold that share of the rows each, so their table is small at any size.
    frequent = F.broadcast(counts.filter(F.col("_rows") * FREQUENT > counts.agg(F.sum("_rows")).scalar())
                           .select(*keys, F.lit(True).alias("_frequent")))
    # Rows without a key match nothing, wherever they are: they are spread too.
    apart = F.coalesce(F.col("_frequent"), F.lit(False)) | F.greatest(F.lit(False), *[F.col(f"`{k}`").isNull() for k in keys])
    spread = df.join(frequent, keys, "left").select(*[f"`{c}`" for c in df.columns], F.when(apart, _salt(df)).otherwise(F.lit(0)).alias("_salt"))
    copies = many.join(frequent, keys, "left").withColumn("_salt", F.explode(
        F.when(F.col("_frequent"), _salts()).otherwise(F.array(F.lit(0).cast("bigint"))))).drop("_frequent")
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def _salts() -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
