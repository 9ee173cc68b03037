"""Worksheet cells to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.functions.money import strip
from footings.functions.text import norm_header

FISCAL_HEADER = r"^FY\s?\d{2,4}$"


def blank(value: Column) -> Column:
    return value.isNull() | (strip(value) == "")


def header_rows(cells: DataFrame, sheet: list[str], pattern: str = FISCAL_HEADER) -> DataFrame:
    """(sheet…, header_row): the row with most matching cells, else the first with two labels."""
    value = F.col("value")
    per_row = cells.groupBy(*sheet, "row").agg(
        F.count_if(strip(value).rlike(pattern)).alias("_hits"),
        F.count_if(~blank(value)).alias("_texts"))
    best = F.min(F.when(F.col("_hits") > 0, F.struct((-F.col("_hits")).alias("h"), F.col("row"))))
    return per_row.groupBy(*sheet).agg(
        F.coalesce(best["row"], F.min(F.when(F.col("_texts") >= 2, F.col("row"))), F.min("row"))
        .alias("header_row"))


def named_cells(cells: DataFrame, sheet: list[str], pattern: str = FISCAL_HEADER) -> DataFrame:
    """Data cells below the header, each with its column's normalised heading.

    The heading side holds one row per sheet column, so a sheet with a third of
    all cells is split by AQE's skew join or meets a broadcast side.
    """
    headers = header_rows(cells, sheet, pattern)
    headed = cells.join(headers, sheet)
    names = (headed.filter("row = header_row and trim(value) != ''")
             .select(*sheet, "col", norm_header(F.col("value")).alias("heading")))
    return headed.filter("row > header_row").join(names, [*sheet, "col"])


def records_from_cells(cells: DataFrame, sheet: list[str], columns: list[str], label: str,
                       pattern: str = FISCAL_HEADER) -> DataFrame:
    """One record per data row with the wanted columns; rows with a blank label drop."""
    named = named_cells(cells, sheet, pattern)
    pick = [F.max(F.when(F.col("heading") == c, F.col("value"))).alias(c) for c in columns]
    return named.groupBy(*sheet, "row").agg(*pick).filter(~blank(F.col(label)))


def records_with_overflow(cells: DataFrame, sheet: list[str], columns: list[str], label: str,
                          pattern: str = FISCAL_HEADER) -> DataFrame:
    """As `records_from_cells`, with every other non-blank heading kept in `other_fields`.

    The map is bounded by the columns of one worksheet row.
    """
    named = named_cells(cells, sheet, pattern)
    pick = [F.max(F.when(F.col("heading") == c, F.col("value"))).alias(c) for c in columns]
    extra = F.when(~F.col("heading").isin(columns) & ~blank(F.col("value")),
                   F.struct("col", "heading", "value"))
    # Of columns with one heading the last one counts.
    found = F.array_sort(F.collect_list(extra))
    headings = F.array_distinct(F.transform(found, lambda x: x["heading"]))
    other = F.map_from_entries(F.transform(headings, lambda h: F.struct(h.alias("heading"), F.element_at(
        F.filter(found, lambda x: x["heading"] == h), -1)["value"].alias("value"))))
    return (named.groupBy(*sheet, "row")
            .agg(*pick, other.alias("other_fields"))
            .filter(~blank(F.col(label))))


def fill_state(cells: DataFrame, sheet: list[str], pattern: str = FISCAL_HEADER,
               label_col: int = 0) -> DataFrame:
    """Cells expected and provided per requested table, and its status.

    Rows with a blank label do not count, nor "total"/"department" rows without values.
    """
    headers = header_rows(cells, sheet, pattern)
    headed = cells.join(headers, sheet)
    wanted = (headed.filter((F.col("row") == F.col("header_row")) & (F.col("col") > label_col)
                            & ~blank(F.col("value"))).select(*sheet, "col"))
    per_sheet = wanted.groupBy(*sheet).agg(F.count("*").alias("_columns"))
    body = headed.filter("row > header_row").join(
        wanted.withColumn("_wanted", F.lit(True)), [*sheet, "col"], "left")
    filled = F.col("_wanted") & ~blank(F.col("value"))
    rows = body.groupBy(*sheet, "row").agg(
        F.max(F.when(F.col("col") == label_col, strip(F.col("value")))).alias("_label"),
        F.count_if(filled).alias("_filled"))
    counted = rows.filter((F.col("_label") != "") & ~(
        F.lower("_label").isin("total", "department") & (F.col("_filled") == 0)))
    out = (counted.groupBy(*sheet).agg(F.count("*").alias("_rows"),
                                       F.sum("_filled").alias("cells_provided"))
           .join(per_sheet, sheet)
           .withColumn("cells_expected", F.col("_rows") * F.col("_columns")).drop("_rows", "_columns"))
    return out.withColumn(
        "status", F.when(F.col("cells_provided") == 0, "unanswered")
        .when(F.col("cells_provided") >= F.col("cells_expected"), "answered").otherwise("partial"))


def profile_cells(cells: DataFrame, sheet: list[str], entities: dict[str, str]) -> DataFrame:
    """Per sheet: non-blank rows, and distinct years and entities its cells mention."""
    text = F.col("value")
    filled = cells.filter(~blank(text))
    rows = filled.select(*sheet, "row").distinct().groupBy(*sheet).agg(F.count("*").alias("rows"))
    flags = filled.groupBy(*sheet).agg(
        F.bool_or(text.contains("Source_ID")).alias("has_source_ids"),
        F.bool_or(strip(text) == "Confidence").alias("has_confidence"),
        *[F.bool_or(text.rlike(p)).alias(f"mentions_{n}") for n, p in entities.items()])
    year = F.col("_y").cast("int")
    years = (filled.select(*sheet, F.explode(F.regexp_extract_all(text, F.lit(r"(?i)\bFY\s?(\d{2,4})\b"),
                                                                  F.lit(1))).alias("_y"))
             .select(*sheet, F.when(year < 100, year + 2000).otherwise(year).alias("_y")).distinct()
             .groupBy(*sheet).agg(F.count("*").alias("years"), F.min("_y").alias("first_year"),
                                  F.max("_y").alias("last_year")))
    return (rows.join(flags, sheet).join(years, sheet, "left")
            .withColumn("years", F.coalesce("years", F.lit(0))))
