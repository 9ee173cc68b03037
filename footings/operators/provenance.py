"""Side tables beside aggregates: every source and value that a result rests on, as rows.

An aggregate says how many and which first; here is the rest, in one shape: the keys of the
result, the role of the entry, its source and its value.  Entries are never put into lists,
so a key with very many sources is very many rows, dealt to as many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.operators.joins import money


def evidence(df: DataFrame, keys: list[str], role: Column, source: Column, value: Column) -> DataFrame:
    """(keys, role, source, value, times): each entry once, however often it is printed."""
    rows = df.select(*keys, role.alias("role"), source.alias("source"), value.alias("value"))
    return rows.groupBy(*keys, "role", "source", "value").agg(F.count("*").alias("times"))


def corroboration_sources(df: DataFrame, key: list[str], value: str, edition: str, digits: int = 6) -> DataFrame:
    """Who prints what: an agreed value with all its editions, a disputed cell with the editions of each value."""
    held = df.filter(F.col(value).isNotNull()).withColumn("_v", F.round(F.col(value), digits))
    ends = held.groupBy(*key).agg((F.min("_v") == F.max("_v")).alias("_one"))
    role = F.when(F.col("_one"), "agreed").otherwise("disputed")
    return evidence(held.join(ends, key), key, role, F.col(edition), F.col("_v"))


def flow_documents(df: DataFrame, keys: list[str], src: str, dst: str, value: str, page: str, doc: str) -> DataFrame:
    """The documents behind each source and destination of a flow matrix: amount and pages.

    Sources whose money adds up to nothing have no row in the matrix and none here.
    """
    row = [*keys, src]
    kept = df.groupBy(*row).agg(F.sum(money(value)).alias("_t")).filter("_t <> 0").select(*row)
    return df.groupBy(*row, dst, doc).agg(F.sum(money(value)).cast("double").alias("amount"), F.min(page).alias("first_page"),
                                          F.max(page).alias("last_page")).join(kept, row, "left_semi")


def name_pairs(df: DataFrame, name: str, container: str) -> DataFrame:
    """Every (name, container) pair with how many containers hold the name."""
    pairs = df.select(name, container).distinct()
    return pairs.join(pairs.groupBy(name).agg(F.count("*").alias("containers")), name)


def sheet_mentions(cells: DataFrame, sheet: list[str], entities: dict[str, str]) -> DataFrame:
    """Years and entities a sheet mentions, one row each with the number of cells: (sheet, role, value, cells)."""
    text, year = F.col("value"), F.col("_y").cast("int")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)\bFY\s?(\d{2,4})\b"), F.lit(1)))
    years = cells.filter(text.isNotNull()).select(*sheet, "row", F.explode(found).alias("_y")).select(
        *sheet, F.lit("year").alias("role"), F.when(year < 100, year + 2000).otherwise(year).cast("string").alias("value"))
    named = F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in entities.items()]))
    entity = cells.filter(text.isNotNull()).select(*sheet, F.lit("entity").alias("role"), F.explode(named).alias("value"))
    return years.unionByName(entity).groupBy(*sheet, "role", "value").agg(F.count("*").alias("cells"))


def missing_figures(rows: DataFrame, page_figures: DataFrame, row_key: list[str], page: list[str], figures: str) -> DataFrame:
    """Each non-zero figure of a row that its cited page, which was read, does not print: (row_key, page, figure)."""
    whole = F.bround(F.abs(F.col("figure")), 0)
    keys = list(dict.fromkeys([*row_key, *page]))
    wanted = rows.select(*keys, F.explode(figures).alias("figure")).filter(whole != 0).withColumn("_f", whole)
    printed = page_figures.select(*page, whole.alias("_f")).distinct()
    read = page_figures.select(*page).distinct()
    return wanted.join(read, page, "left_semi").join(printed, [*page, "_f"], "left_anti").select(*keys, "figure")


def readings_behind(theirs: DataFrame, facts: DataFrame, keys: list[str], value: str, source: str) -> DataFrame:
    """All readings held of a figure that a workbook states, with their sources and their gap to it."""
    mine = facts.select(*keys, F.col(source).alias("source"), F.col(value).alias("reading"))
    return mine.join(theirs.select(*keys, F.col(value).alias("_theirs")), keys).withColumn(
        "gap", F.round(F.col("_theirs") - F.col("reading"), 2)).drop("_theirs")


def vintage_trail(df: DataFrame, keys: list[str], recency: Column, value: str, source: str) -> DataFrame:
    """Every reading of a year with how recent its document is and how far it is from the first: (keys, recency, source, value, moved)."""
    first = df.groupBy(*keys).agg(F.min(F.struct(recency.alias("r"), F.col(source).alias("s"), F.col(value).alias("v")))["v"].alias("_first"))
    rows = df.select(*keys, recency.alias("recency"), F.col(source).alias("source"), F.col(value).alias("value")).join(first, keys)
    return rows.withColumn("moved", F.round(F.col("value") - F.col("_first"), 2)).drop("_first")
