"""Fiscal years: 2027 is the year ending 30 June 2027."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ways a fiscal year is printed, in order of trust.
YEAR_END = r"June\s*30,?\s*(20\d{2})"
FY_LONG = r"(?i)\bFY\s?(20\d{2})\b"
FY_SHORT = r"(?i)\bFY\s?(\d{2})\b"
FISCAL_YEAR_WORDS = r"(?i)Fiscal\s+Year\s+(20\d{2})"
FILE_FY_LONG = r"(?i)FY[\s_]?(\d{4})"
FILE_FY_SHORT = r"(?i)FY[\s_]?(\d{2})(?!\d)"
BARE_YEAR = r"\b(20\d{2})\b"
ANNUAL_REPORT = r"(?i)CAFR|ACFR|Annual\s+(?:Comprehensive\s+)?Financial|Audit"


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("int")


def fiscal_year(text: Column) -> Column:
    """Year end date, then FY2027, then FY27, then the words; null when none is printed."""
    return F.coalesce(_found(text, YEAR_END), _found(text, FY_LONG),
                      _found(text, FY_SHORT) + F.lit(2000), _found(text, FISCAL_YEAR_WORDS))


def report_year(filename: Column) -> Column:
    """`fiscal_year`, then the file-name shapes; a bare year counts only for annual reports."""
    long_year = _found(filename, FILE_FY_LONG)
    named = F.when(long_year > 99, long_year).otherwise(long_year + 2000)
    return F.coalesce(fiscal_year(filename), named, _found(filename, FILE_FY_SHORT) + F.lit(2000),
                      F.when(filename.rlike(ANNUAL_REPORT), _found(filename, BARE_YEAR)))


def fy_id(value: Column) -> Column:
    """FY2027, FY27, 27 or 2027 → `FY2027`."""
    number = F.regexp_replace(value.cast("string"), "^FY", "").try_cast("int")
    return F.concat(F.lit("FY"), F.when(number > 99, number).otherwise(number + 2000).cast("string"))


def fy_short(year: Column) -> Column:
    """2027 → `FY27`."""
    return F.concat(F.lit("FY"), F.lpad(F.pmod(year, F.lit(100)).cast("string"), 2, "0"))


def fiscal_bounds(year: Column) -> Column:
    """1 July of the year before to 30 June, as a struct of dates."""
    return F.struct(F.make_date(year - 1, F.lit(7), F.lit(1)).alias("starts"),
                    F.make_date(year, F.lit(6), F.lit(30)).alias("ends"))
