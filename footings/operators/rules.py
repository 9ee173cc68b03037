"""Prose rules: one figure per rule and document, with the first page that states it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A metric and the pattern whose first group is its figure."""

    metric: str
    pattern: str
    unit: str = ""
    basis: str = ""


def regex_scalars(pages: DataFrame, rules: list[Rule], doc: str, page: str, text: str) -> DataFrame:
    """One row per document and rule: value, page, phrase; `found` false marks a miss.

    All rules are tried in one pass; the first page per rule is a map-side
    combined minimum, so a document of any length shuffles one row per task.
    """
    source = F.col(text)
    hits = []
    for i, rule in enumerate(rules):
        phrase = F.regexp_extract(source, rule.pattern, 0)
        figure = F.regexp_replace(F.regexp_extract(source, rule.pattern, 1), ",", "")
        hit = F.struct(F.col(page).alias("page"), figure.try_cast("double").alias("value"),
                       phrase.alias("phrase"))
        hits.append(F.min(F.when(source.rlike(rule.pattern), hit)).alias(f"_rule_{i}"))
    found = pages.groupBy(doc).agg(*hits)
    rows = F.array(*[
        F.struct(F.lit(r.metric).alias("metric"), F.lit(r.unit).alias("unit"),
                 F.lit(r.basis).alias("basis"), F.col(f"_rule_{i}").alias("hit"))
        for i, r in enumerate(rules)])
    row = F.col("_row")
    return (found.select(doc, F.explode(rows).alias("_row"))
            .select(doc, row["metric"].alias("metric"), row["unit"].alias("unit"),
                    row["basis"].alias("basis"), row["hit"]["value"].alias("value"),
                    row["hit"]["page"].alias("page"), row["hit"]["phrase"].alias("phrase"),
                    row["hit"].isNotNull().alias("found")))


def check_rows(df: DataFrame, keys: list[str], checks: Column) -> DataFrame:
    """Named tests (see `stated_checks`) as rows of (keys…, check, agree)."""
    return df.select(*keys, F.explode(checks).alias("_c")).select(
        *keys, F.col("_c")["check"].alias("check"), F.col("_c")["agree"].alias("agree"))


def first_hit(pages: DataFrame, doc: str, page: str, text: str, pattern: str) -> DataFrame:
    """First page of each document on which a pattern occurs (documents without one drop out)."""
    return pages.filter(F.col(text).rlike(pattern)).groupBy(doc).agg(F.min(page).alias(page))
