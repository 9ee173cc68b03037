"""Small arithmetic tests on stated figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """part ÷ whole × 100, rounded; null when the whole is zero or missing."""
    return F.round(F.try_divide(part, F.nullif(whole, F.lit(0.0))) * 100, digits)


def spread_pct(low: Column, high: Column) -> Column:
    """Spread as a percentage of the smaller reading, one decimal; null when it is zero."""
    return pct_of(high - low, F.abs(low), 1)


def cents_equivalent(dollars: Column, penny_yield: Column) -> Column:
    """Dollars as cents on the rate; null without a usable yield."""
    return F.try_divide(dollars, F.nullif(penny_yield, F.lit(0.0)))


def within(a: Column, b: Column, tolerance: float) -> Column:
    """|a − b| < tolerance; null when either is missing."""
    return F.abs(a - b) < F.lit(tolerance)


def within_share(a: Column, b: Column, share: float) -> Column:
    """|a − b| below a share of b."""
    return F.try_divide(F.abs(a - b), F.abs(b)) < F.lit(share)


def project_change(original: Column, increase: Column, current: Column) -> Column:
    """Increase in per cent, and whether original + increase makes the current figure."""
    return F.struct(
        F.round(F.try_divide(current - original, F.nullif(original, F.lit(0.0))) * 100, 1)
        .alias("increase_pct"),
        within(original + increase, current, 1000.0).alias("consistent"))


def budget_variance(budget: Column, actual: Column) -> Column:
    """Size and direction of a variance; null without a non-zero budget and an actual."""
    diff = budget - actual
    signed = F.try_divide(diff, F.nullif(budget, F.lit(0.0))) * 100
    return F.when(signed.isNotNull(), F.struct(
        F.abs(signed).alias("pct"), signed.alias("signed_pct"), F.abs(diff).alias("amount"),
        F.when(diff > 0, "under").when(diff < 0, "over").otherwise("exact").alias("direction")))


def stated_checks(rows: list[tuple[str, Column]]) -> Column:
    """Named tests as an array of (check, agree), ready to explode; null means untestable."""
    return F.array(*[F.struct(F.lit(name).alias("check"), test.alias("agree"))
                     for name, test in rows])
