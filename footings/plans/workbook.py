"""The issues log and request workbook: typed records out of worksheet cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footings.functions.checks import project_change
from footings.sources.cells import records_from_cells

# Headings of the cost-change sheet.
COST_HEADINGS = ["Project", "Original", "Current", "Increase"]


def cost_changes(cells: DataFrame, sheet: list[str], read) -> DataFrame:
    """One row per project: figures read from their suffixed cells, and their own arithmetic."""
    rows = records_from_cells(cells, sheet, COST_HEADINGS, "Project")
    figures = {name: read(F.col(name)) for name in COST_HEADINGS[1:]}
    change = project_change(figures["Original"]["value"], figures["Increase"]["value"],
                            figures["Current"]["value"])
    return rows.select(
        *sheet, F.col("Project").alias("project"),
        *[figures[n]["value"].alias(n.lower()) for n in figures],
        change["increase_pct"].alias("increase_pct"), change["consistent"].alias("consistent"),
        F.coalesce(*[f["note"] for f in figures.values()]).alias("note"))
