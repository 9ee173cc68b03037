"""Proof by arithmetic: a figure is shown only when its own page confirms it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footings.operators.joins import money


def prove_columns(members: DataFrame, totals: DataFrame, keys: list[str], values: str = "values",
                  tol: float = 0.005) -> DataFrame:
    """Per group and column: the lines' sum against the printed total.

    `reconciles` is null where there is nothing to test; the variance is kept.
    """
    lines = members.select(*keys, F.posexplode(values).alias("column_index", "_v"))
    sums = lines.groupBy(*keys, "column_index").agg(F.sum(money("_v")).cast("double").alias("sum_of_lines"),
                                                    F.count("_v").alias("lines"))
    printed = totals.select(*keys, F.posexplode(values).alias("column_index", "printed_total"))
    out = printed.join(sums, [*keys, "column_index"], "left").na.fill(0, ["lines"])
    gap = F.round(F.col("sum_of_lines") - F.col("printed_total"), 4)
    return out.withColumn("variance", F.round(gap, 2)).withColumn("reconciles", F.abs(gap) < tol)


def prove_groups(columns: DataFrame, keys: list[str]) -> DataFrame:
    """A group is proven when at least one column is testable and every testable one holds."""
    return columns.groupBy(*keys).agg(
        F.count("reconciles").alias("columns_checked"),
        F.coalesce(F.bool_and("reconciles"), F.lit(False)).alias("proven"))


def prove_offset(columns: DataFrame, keys: list[str], tol: float = 1.5) -> DataFrame:
    """Groups whose lines stand in one column and their total in the next.

    The window spans the columns of one printed group, a handful of rows.
    """
    w = Window.partitionBy(*keys).orderBy("column_index")
    nxt = columns.select("*", F.lead("printed_total").over(w).alias("_next"))
    hit = (F.col("printed_total").isNull() & (F.col("lines") >= 2)
           & (F.abs(F.col("sum_of_lines") - F.col("_next")) < tol))
    first = F.min(F.when(hit, F.struct("column_index", "sum_of_lines", "_next")))
    return nxt.groupBy(*keys).agg(first.alias("_o")).filter("_o is not null").select(
        *keys, F.col("_o")["column_index"].alias("members_column"),
        (F.col("_o")["column_index"] + 1).alias("total_column"),
        F.col("_o")["sum_of_lines"].alias("sum_of_lines"), F.col("_o")["_next"].alias("printed_total"))


# The provable column layouts.
VARIANCE_AT_3 = ["original_budget", "final_budget", "actual", "variance"]
VARIANCE_AT_2 = ["budget", "actual", "variance", "prior_year_actual"]
PROJECT = ["project_authorization", "prior_years_actual", "current_year_actual", "total_to_date", "variance"]


def infer_roles(totals: DataFrame, keys: list[str], values: str = "values", min_hits: int = 3,
                tol: float = 1.5) -> DataFrame:
    """Column roles per statement, from identities that its own totals satisfy.

    Totals are pooled over all pages of a statement; fewer than `min_hits` agreeing
    rows leave the roles unknown (null).  One aggregation, no join.
    """
    v = [F.get(F.col(values), F.lit(i)) for i in range(4)]

    def variance(b, a, d):
        return (F.abs(a - b - d) < tol) | (F.abs(b - a - d) < tol)

    n = F.size(values)
    hits = totals.groupBy(*keys, n.alias("columns")).agg(
        F.count_if(variance(v[1], v[2], v[3])).alias("_late"),
        F.count_if(variance(v[0], v[1], v[2])).alias("_early"),
        F.count_if(F.abs(v[1] + v[2] - v[3]) < tol).alias("_project"))
    cols = F.col("columns")

    def roles(names):
        pairs = F.transform(F.sequence(F.lit(1), F.least(cols, F.lit(len(names)))), lambda i: F.struct(
            (i - 1).cast("string").alias("k"), F.element_at(F.array(*[F.lit(x) for x in names]), i).alias("v")))
        return F.map_from_entries(pairs)

    late = (cols >= 4) & (F.col("_late") >= min_hits)
    early = (cols >= 3) & (F.col("_early") >= min_hits)
    project = (cols >= 4) & (F.col("_project") >= min_hits)
    layout = (F.when(late, "variance after three columns").when(early, "variance after two columns")
              .when(project, "capital project schedule"))
    mapped = (F.when(late, roles(VARIANCE_AT_3)).when(early, roles(VARIANCE_AT_2))
              .when(project, roles(PROJECT)))
    return hits.select(*keys, "columns", layout.alias("layout"), mapped.alias("column_roles"))


# The lines of a roll-forward.
ROLLFORWARD = {
    "revenues": r"(?i)^Total\s+revenues?$",
    "expenditures": r"(?i)^Total\s+expenditures?$",
    "over": r"(?i)^(?:Revenues\s+over|Excess\s+of\s+revenues)",
    "change": r"(?i)^(?:Net\s+change\s+in\s+fund\s+balance|Change\s+in\s+fund\s+balance)",
    "begin": r"(?i)^Fund\s+balance,?\s+beginning",
    "end": r"(?i)^Fund\s+balance,?\s+end",
}


def prove_rollforward(rows: DataFrame, part: list[str], ordinal: str, label: str, values: str,
                      tol: float = 1.5) -> DataFrame:
    """Lines outside every subtotal, proven by the statement's own roll-forward.

    One row per proven (page, line, column); the first matching line of each kind
    counts, found by map-side minimum.  Other lines decide nothing and are not moved.
    """
    def first(kind):
        return F.min(F.when(F.array_contains("_kinds", kind), F.struct(ordinal, label, values)))

    kinds = F.array_compact(F.array(*[F.when(F.col(label).rlike(p), F.lit(n)) for n, p in ROLLFORWARD.items()]))
    named = rows.filter(F.exists(F.col(values), lambda x: x.isNotNull())).select(*part, ordinal, label, values, kinds.alias("_kinds")) \
        .filter(F.size("_kinds") > 0)
    page = named.groupBy(*part).agg(*[first(n).alias(f"_{n}") for n in ROLLFORWARD],
                                   F.max(F.size(values)).alias("_cols"))
    each = page.select("*", F.explode(F.sequence(F.lit(0), F.col("_cols") - 1)).alias("column_index"))

    def at(name):
        return F.get(F.col(f"_{name}")[values], F.col("column_index"))

    def claim(name, identity, want):
        return F.struct(F.lit(identity).alias("identity"), F.col(f"_{name}")[label].alias("line"),
                        at(name).alias("value"), want.alias("expected"))

    claims = F.array(
        claim("over", "total revenues minus total expenditures", at("revenues") - at("expenditures")),
        claim("end", "fund balance beginning plus net change", at("begin") + at("change")),
        claim("begin", "fund balance ending minus net change", at("end") - at("change")))
    out = each.select(*part, "column_index", F.inline(claims))
    return out.filter(F.abs(F.col("value") - F.col("expected")) < tol)
