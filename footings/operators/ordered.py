"""Ordered work inside a group, without one task ever holding a whole group.

`chunk` is a column that never decreases along the order (a page block, a day, the
leading letters of a key).  Each chunk is worked on its own; one summary row per
chunk then carries state into the next, and is joined back.  A group with a third
of all rows is thereby spread over its chunks, and only the summary window sees the
group as a whole.  Summaries grow with the groups, so they are merged and never broadcast:
compressed they look small to Spark, in the driver they are not.  `chunk=None` is for groups with a physical bound, such as the
lines of one printed page.  Group keys must not be null, and the order must be total.

One `scan` reads its input twice (rows and summary), however many states it
carries.  Chaining scans therefore multiplies; jobs that need several put
`session.stored` between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scan(df: DataFrame, part: list[str], order: list[str], chunk: str | None = None,
         latest: dict[str, Column] | None = None, earlier: dict[str, Column] | None = None,
         sums: dict[str, Column] | None = None) -> DataFrame:
    """Add carried state in one pass.

    `latest` is the last non-null value up to and including the row, `earlier` the last
    one strictly before it, `sums` the running sum with the row included.
    """
    latest, earlier, sums = latest or {}, earlier or {}, sums or {}
    sums = {n: F.coalesce(c, F.lit(0)) for n, c in sums.items()}
    w = Window.partitionBy(*part, *([chunk] if chunk else [])).orderBy(*order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    local = [F.last(c, ignorenulls=True).over(upto).alias(n) for n, c in latest.items()] \
        + [F.last(c, ignorenulls=True).over(before).alias(n) for n, c in earlier.items()] \
        + [F.sum(c).over(upto).alias(n) for n, c in sums.items()]
    if chunk is None:
        return df.select("*", *local)

    carried = {**latest, **earlier}
    ends = df.groupBy(*part, chunk).agg(
        *[F.max(F.when(c.isNotNull(), F.struct(F.struct(*order).alias("_o"), c.alias("_v"))))["_v"].alias(f"_c_{n}")
          for n, c in carried.items()],
        *[F.sum(c).alias(f"_c_{n}") for n, c in sums.items()])
    past = Window.partitionBy(*part).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    prior = ends.select(
        *part, chunk, *[F.last(f"_c_{n}", ignorenulls=True).over(past).alias(f"_c_{n}") for n in carried],
        *[F.sum(f"_c_{n}").over(past).alias(f"_c_{n}") for n in sums])
    joined = df.select("*", *local).join(prior.hint("merge"), [*part, chunk])
    return joined.select(*df.columns, *[F.coalesce(n, f"_c_{n}").alias(n) for n in carried],
                         *[(F.col(n) + F.coalesce(f"_c_{n}", F.lit(0))).alias(n) for n in sums])


def carry_forward(df: DataFrame, part: list[str], order: list[str], cols: dict[str, Column],
                  chunk: str | None = None) -> DataFrame:
    """Add each column's latest non-null value up to and including the row."""
    return scan(df, part, order, chunk, latest=cols)


def running_sum(df: DataFrame, part: list[str], order: list[str], value: Column, out: str,
                chunk: str | None = None) -> DataFrame:
    """Add the running sum of a value, the row included; nulls add nothing."""
    return scan(df, part, order, chunk, sums={out: value})


def ordinal(df: DataFrame, part: list[str], order: list[str], out: str, chunk: str | None = None) -> DataFrame:
    """Number the rows of each group from 1 in order."""
    return running_sum(df, part, order, F.lit(1).cast("long"), out, chunk)


def gap_islands(df: DataFrame, part: list[str], order: list[str], start: Column, end: Column,
                tol: float, out: str, chunk: str | None = None) -> DataFrame:
    """Number the clusters of each group: one ends where the next start is over `tol` past it.

    A chunk's summary is its first start, its last end and the breaks inside it, so the
    break between two chunks is settled among summaries and one pass is enough.
    """
    w = Window.partitionBy(*part, *([chunk] if chunk else [])).orderBy(*order)
    gap = F.coalesce((start - F.lag(end).over(w) > tol).cast("long"), F.lit(0).cast("long"))
    marked = df.select("*", gap.alias("_new"))
    inside = marked.select("*", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(out))
    if chunk is None:
        return inside.drop("_new")
    place = F.struct(*order)
    ends = marked.groupBy(*part, chunk).agg(
        F.min(F.struct(place.alias("o"), start.alias("v")))["v"].alias("_first"),
        F.max(F.struct(place.alias("o"), end.alias("v")))["v"].alias("_last"), F.sum("_new").alias("_inner"))
    over = Window.partitionBy(*part).orderBy(chunk)
    opened = F.coalesce((F.col("_first") - F.lag("_last").over(over) > tol).cast("long"), F.lit(0).cast("long"))
    opened = ends.select(*part, chunk, "_inner", opened.alias("_open"))
    before = F.sum(F.col("_inner") + F.col("_open")).over(over.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_inner")
    prior = opened.select(*part, chunk, before.alias("_base"))
    return inside.join(prior.hint("merge"), [*part, chunk]).select(*df.columns, (F.col(out) + F.col("_base")).alias(out))


def fill_down(df: DataFrame, part: list[str], order: list[str], levels: dict[str, Column],
              chunk: str | None = None) -> DataFrame:
    """Carry section headings down; a heading clears every level below it.

    `levels` maps names to the heading text on its own line (null elsewhere),
    highest level first.
    """
    place = F.struct(*([chunk] if chunk else []), *order)
    marks = {f"_m_{n}": F.when(c.isNotNull(), F.struct(place.alias("at"), c.alias("text")))
             for n, c in levels.items()}
    out = carry_forward(df, part, order, marks, chunk)
    picked = []
    for i, name in enumerate(levels):
        own = F.col(f"_m_{name}")
        cleared = [F.when(own["at"] < F.col(f"_m_{h}")["at"], F.lit(True)) for h in list(levels)[:i]]
        stale = F.coalesce(*cleared, F.lit(False))
        picked.append(F.when(~stale, own["text"]).alias(name))
    return out.select(*df.columns, *picked)
