"""Grids and lists inside message pages.

Each of these reads one page with array functions on the page's own row: nothing is
exploded before the figures are known, and only pages that can hold a figure are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.functions.money import parse_number_prose, strip

# The printed shape of the projection grid and the rate-impact block.
GRID_TITLE = "Projected Surplus/(Deficit)"
GRID_NUMBER = r"\(?-?\$?\s?[\d,]+(?:\.\d+)?%?\)?%?"
GRID_BASIS = {"estimate": "estimate", "budget": "budget", "projection": "projected", "actual": "actual",
              "recommended": "recommended"}
BLOCK_TITLE = "Rate Impact"
LEVELS_HEADER = r"([\d,]+)\s*gallons per month\s+([\d,]+)\s*gallons per month"
LOCATIONS = [("In-Town Rates", "intown"), ("Out-of-Town Rates", "outoftown")]
SERVICES = ["Water", "Sewer"]


def _words(line: Column) -> Column:
    return F.split(strip(line), r"\s+")


def _index(lines: Column, test) -> Column:
    """Position (from 1) of the first line that passes, or null."""
    places = F.filter(F.transform(lines, lambda x, i: F.when(test(x), i + 1)), lambda i: i.isNotNull())
    return F.get(places, F.lit(0))


def _from(lines: Column, start: Column) -> Column:
    return F.slice(lines, F.coalesce(start, F.lit(1)), F.greatest(F.size(lines), F.lit(1)))


def projection_grid(pages: DataFrame, metrics: list[tuple[str, str, str]]) -> DataFrame:
    """Facts of the projection grid on each document's first page that holds one.

    The years are the first line of fiscal years below the title, however far; the bases
    are the first line below that names one for every year.

    `metrics` lists (pattern before the figures, metric, unit).  A row whose figures do
    not match the years is no fact; `grid_problems` has it.
    """
    rows = _grid_rows(pages, metrics).filter(F.size("figures") == F.size("_years"))
    return rows.select("doc_id", "page_no", "metric", "unit", F.inline(F.arrays_zip(
        F.col("_years").alias("fiscal_year"), F.col("_basis").alias("basis"), F.col("figures").alias("value"))))


def grid_problems(pages: DataFrame, metrics: list[tuple[str, str, str]]) -> DataFrame:
    """Printed rows of the grids whose figures do not match the years: doc_id, page_no, metric, years, figures."""
    rows = _grid_rows(pages, metrics).filter(F.col("printed") & (F.size("figures") != F.size("_years")))
    return rows.select("doc_id", "page_no", "metric", F.size("_years").alias("years"), "figures")


def _grid_rows(pages: DataFrame, metrics: list[tuple[str, str, str]]) -> DataFrame:
    """Per document and metric: the years and bases of its grid, whether the row is printed, and its figures."""
    lines = F.split("text", "\n")

    def is_years(line):
        return F.forall(_words(line), lambda w: w.rlike(r"^FY\d{2,4}$"))

    # Few pages hold a grid: those few are spread over all cores before they are read.
    titled = pages.filter(F.col("text").contains(GRID_TITLE)).repartition("doc_id", "page_no")
    grid = titled.withColumn("_lines", lines) \
        .withColumn("_at", _index(F.col("_lines"), lambda x: x.contains(GRID_TITLE)))
    below = _index(_from(F.col("_lines"), F.col("_at")), is_years)
    grid = grid.withColumn("_hdr", F.col("_at") + below - 1).filter("_hdr is not null")
    year = F.transform(_words(F.element_at("_lines", F.col("_hdr"))), lambda w: F.when(
        F.length(w) == 4, F.substring(w, 3, 2).cast("int") + 2000).otherwise(F.substring(w, 3, 4).cast("int")))
    grid = grid.withColumn("_years", year)
    known = F.array(*[F.lit(b) for b in GRID_BASIS])
    names = F.create_map(*[F.lit(x) for pair in GRID_BASIS.items() for x in pair])
    basis_line = F.get(F.filter(_from(F.col("_lines"), F.col("_hdr")), lambda x: (
        F.size(_words(x)) == F.size("_years")) & F.forall(_words(F.lower(x)), lambda w: F.array_contains(known, w))), F.lit(0))
    basis = F.when(basis_line.isNotNull(), F.transform(_words(F.lower(basis_line)), lambda w: names[w])) \
        .otherwise(F.transform("_years", lambda _: F.lit("reported")))
    grid = grid.withColumn("_basis", basis)
    # The first page per document is a minimum, so each page is read once.
    first = F.min(F.struct("page_no", "_lines", "_years", "_basis"))
    grid = grid.groupBy("doc_id").agg(first.alias("_g")).select("doc_id", "_g.*")

    def row(pattern, metric, unit):
        full = pattern + r"\s*(.*)$"
        line = F.get(F.filter("_lines", lambda x: x.rlike(full)), F.lit(0))
        figures = F.filter(F.transform(F.regexp_extract_all(F.regexp_extract(line, full, 1), F.lit(GRID_NUMBER), F.lit(0)),
                                       parse_number_prose), lambda v: v.isNotNull())
        return F.struct(F.lit(metric).alias("metric"), F.lit(unit).alias("unit"), figures.alias("figures"), line.isNotNull().alias("printed"))

    return grid.select("doc_id", "page_no", "_years", "_basis", F.inline(F.array(*[row(*m) for m in metrics])))


def rate_impact(pages: DataFrame) -> DataFrame:
    """Published bill increases: location × service × consumption level.

    Nothing is labelled unless the page also states its consumption levels.
    """
    text = F.col("text")
    stated = pages.filter(text.contains(BLOCK_TITLE))
    first = stated.groupBy("doc_id").agg(F.min(F.struct("page_no", "text")).alias("_p")).select("doc_id", "_p.*")
    block = first.filter(text.rlike(LEVELS_HEADER))
    block = block.withColumn("_block", F.substring(text, F.instr(text, F.lit(BLOCK_TITLE)), F.length(text)))
    cells = []
    for label, location in LOCATIONS:
        start = F.instr(F.col("_block"), F.lit(label))
        # A location's figures end where the next location is named.
        after = F.when(start > 0, F.substring(F.col("_block"), start + len(label), F.length("_block")))
        nexts = [F.nullif(F.instr(after, F.lit(other)), F.lit(0)) for other, _ in LOCATIONS if other != label]
        reach = F.substring(after, F.lit(1), F.coalesce(*nexts, F.length(after)))
        for service in SERVICES:
            pattern = service + r"\s+\$([\d.,]+)\s+\$([\d.,]+)"
            for group, level in ((1, "avg"), (2, "min")):
                gallons = F.regexp_replace(F.regexp_extract(text, LEVELS_HEADER, group), ",", "").try_cast("int")
                value = F.regexp_replace(F.regexp_extract(reach, pattern, group), ",", "").try_cast("double")
                cells.append(F.struct(F.lit(location).alias("location"), F.lit(service.lower()).alias("service"),
                                      F.lit(level).alias("level"), gallons.alias("gallons"), value.alias("value")))
    return block.select("doc_id", "page_no", F.inline(F.array(*cells))).filter("value is not null")


def bullets_after(pages: DataFrame, heading: str, stop: list[str]) -> DataFrame:
    """Unpunctuated lines under a heading, up to a line that starts with a stop phrase."""
    text = F.col("text")
    found = pages.filter(text.contains(heading))
    rest = F.substring(text, F.instr(text, F.lit(heading)) + len(heading), F.length(text))
    lines = F.filter(F.transform(F.split(rest, "\n"), strip), lambda s: s != "")
    stops = F.array(*[F.lit(x) for x in stop])
    end = _index(lines, lambda s: F.exists(stops, lambda x: s.startswith(x)))
    kept = F.when(end.isNull(), lines).otherwise(F.slice(lines, F.lit(1), F.greatest(end - 1, F.lit(0))))
    items = F.filter(kept, lambda s: ~s.rlike(r"[.:?]$"))
    return found.select("doc_id", "page_no", F.posexplode(items).alias("item_no", "item"))
