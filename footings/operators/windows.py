"""Selection of one reading, series arithmetic, and printed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footings import vocab
from footings.functions.money import strip
from footings.operators import ordered
from footings.operators.filters import lookup


def first_ranked(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key.

    A plain rank filter: Spark keeps only k rows per key and task before the
    shuffle, so a key with a third of all rows costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def latest_by(df: DataFrame, keys: list[str], recency: Column, ordinal: Column) -> DataFrame:
    """One reading per key from the most recent document; the first row wins ties.

    Rows with a null key (an unknown year) are not readings of any year.
    """
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return first_ranked(df, keys, [recency.desc_nulls_last(), ordinal.asc()])


def latest(df: DataFrame, keys: list[str], recency: Column, ordinal: Column) -> DataFrame:
    """The one reading to publish per metric: most recent document, first row on ties."""
    return first_ranked(df, keys, [recency.desc_nulls_last(), ordinal.asc()])


def for_year(df: DataFrame, keys: list[str], year: str, wanted: int, recency: Column, ordinal: Column) -> DataFrame:
    """The reading for one named year, never another year's latest."""
    return latest_by(df.filter(F.col(year) == wanted), [*keys, year], recency, ordinal)


def best_basis(df: DataFrame, keys: list[str], basis: str, year: str, doc: str, rank: dict | None = None) -> DataFrame:
    """Firmest basis, then newest year, then document id."""
    firm = F.coalesce(lookup(F.col(basis), rank or vocab.BASIS_RANK), F.lit(vocab.BASIS_RANK_OTHER))
    return first_ranked(df, keys, [firm.asc(), F.coalesce(F.col(year), F.lit(0)).desc(), F.col(doc).cast("string").asc()])


def last_row(df: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    """The last row of each key in file order."""
    return first_ranked(df, keys, [F.col(o).desc() for o in ordinal])


def yoy(series: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """Change on the year before and since the first year, in per cent, and the plain delta.

    `series` holds one row per key and year, so a window spans a key's years only.
    """
    by_year = Window.partitionBy(*keys).orderBy(year)
    whole = by_year.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    prev, first = F.lag(value).over(by_year), F.first(value).over(whole)

    def pct(base):
        return F.round(F.try_divide(F.col(value) - base, F.nullif(base, F.lit(0.0))) * 100, 2)

    later = F.lag(year).over(by_year).isNotNull()
    return series.select(
        "*", pct(prev).alias("yoy_pct"), F.when(later, pct(first)).alias("change_pct_since_first"),
        F.when(later, F.round(F.col(value) - prev, 2)).alias("delta"))


def latest_change(series: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """The last two years of each series and their difference; one year alone proves no change."""
    two = first_ranked(series, keys, [F.col(year).desc()], 2)
    pick = F.struct(year, value)
    return two.groupBy(*keys).agg(F.min(pick).alias("_p"), F.max(pick).alias("_c"), F.count("*").alias("_n")) \
        .filter("_n = 2").select(*keys, F.col("_p")[year].alias("prev_year"), F.col("_c")[year].alias("cur_year"),
                                 F.round(F.col("_c")[value] - F.col("_p")[value], 2).alias("delta"))


def grain_ordinal(df: DataFrame, grain: list[str], order: list[str], repeatable: Column, out: str = "line",
                  chunk: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(numbered rows, violations): printed order inside a grain.

    Only a repeatable source may print one grain twice; otherwise the grain is a violation
    and its first row alone is kept.
    """
    numbered = ordered.ordinal(df.filter(repeatable), grain, order, out, chunk)
    single = first_ranked(df.filter(~repeatable), grain, [F.col(c).asc() for c in order]).withColumn(out, F.lit(1).cast("long"))
    clash = df.groupBy(*grain).agg(F.count("*").alias("rows"), F.count_if(~repeatable).alias("_single")) \
        .filter("rows > 1 and _single > 0").drop("_single")
    return numbered.unionByName(single), clash


def fixed_bands(df: DataFrame, coordinate: str, size: float = 3.0, out: str = "band") -> DataFrame:
    """Lines by rounding a coordinate to bins, halves to even."""
    return df.withColumn(out, F.bround(F.col(coordinate) / size, 0).cast("int"))


def column_grid(points: DataFrame, part: list[str], island: str, edge: str, left: str, min_hits: int = 3,
                mean_edge: bool = False, margin: float = 4.0) -> DataFrame:
    """Figure columns of a page: clusters that recur, numbered from the left.

    The label boundary is the leftmost start in the first column, less a margin.
    The window spans the columns of one page.
    """
    at = F.avg(edge) if mean_edge else F.max(edge)
    kept = points.groupBy(*part, island).agg(F.count("*").alias("hits"), at.alias("edge"), F.min(left).alias("_left")) \
        .filter(F.col("hits") >= min_hits)
    w = Window.partitionBy(*part).orderBy("edge")
    first = F.first("_left").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return kept.select(*part, (F.row_number().over(w) - 1).alias("column"), "edge", "hits",
                       (first - margin).alias("boundary"))


def assemble_tokens(chars: DataFrame, part: list[str], island: str, text: str, x0: str, x1: str) -> DataFrame:
    """One token per cluster: texts in reading order, outer edges, and the last digit's right edge.

    A cluster is a run of touching marks on one printed line.
    """
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(x0), F.col(x1), F.col(text).alias("t")))),
                                      lambda c: c["t"]), "")
    digit = F.max(F.when(F.col(text).rlike(r"\d"), F.struct(F.col(x0), F.col(x1).alias("e"))))["e"]
    return chars.groupBy(*part, island).agg(joined.alias("text"), F.min(x0).alias("x0"), F.max(x1).alias("x1"),
                                            digit.alias("digit_x1"))


def wrap_labels(lines: DataFrame, part: list[str], order: str, label: str, is_row: Column, is_text: Column,
                text: str, stop: Column | None = None) -> DataFrame:
    """Figure rows with their full labels: a name printed around its figures is put together.

    A row without a label takes the latest text line since the row above, and the
    line right below it, unless `stop` rules that line out.  A line used up that way is not offered to the next
    row; in a run of such rows the line between two of them belongs to every other
    row, which is what the alternating position in the run decides.  `part` is one
    printed table, so the windows span its lines.
    """
    w = Window.partitionBy(*part).orderBy(order)
    lines = lines.select("*", is_row.alias("_row"), is_text.alias("_text"),
                         (F.lit(True) if stop is None else ~stop).alias("_short"))
    columns = [c for c in lines.columns if c not in ("_row", "_text", "_short")]
    bare, fragment = F.col("_row") & (F.col(label) == ""), F.col("_text") & F.col("_short")
    lines = lines.select("*", bare.alias("_bare"), fragment.alias("_frag"))
    marked = lines.select(
        "*", F.lead(F.when(F.col("_frag"), F.col(text))).over(w).alias("_below"),
        F.lag("_frag").over(w).alias("_frag_above"), F.lag("_bare", 2).over(w).alias("_second_bare"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.select("*", F.last(F.when(F.col("_row"), F.col(order)), True).over(before).alias("_row_at"),
                           F.last(F.when(F.col("_text"), F.struct(F.col(order).alias("at"), F.col(text).alias("t"))), True)
                           .over(before).alias("_last_text"))
    fresh = F.col("_last_text").isNotNull() & (
        F.col("_row_at").isNull() | (F.col("_last_text")["at"] > F.col("_row_at")))
    # The only line between this row and another bare row above it.
    link = F.col("_bare") & F.coalesce(F.col("_second_bare") & F.col("_frag_above"), F.lit(False))
    rows = marked.filter("_row").select("*", fresh.alias("_fresh"), link.alias("_link"))
    rows = rows.withColumn("_run", F.sum(F.when(F.col("_link"), 0).otherwise(1)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*part, "_run").orderBy(order)
    place = F.row_number().over(run) - 1
    head = F.first(F.col("_bare") & F.col("_fresh")).over(run.rowsBetween(Window.unboundedPreceding, 0))
    taken = rows.select("*", (F.col("_bare") & F.when(place % 2 == 0, head).otherwise(~head)).alias("_takes"))
    full = F.concat_ws(" ", F.col("_last_text")["t"], F.col("_below"))
    return taken.withColumn(label, F.when(F.col("_takes"), full).otherwise(F.col(label))) \
        .select(*columns)


def stitch_segments(rows: DataFrame, part: list[str], label: str, order: str, values: str) -> DataFrame:
    """One row per label: the values of its printed segments one after the other.

    A label has as many rows as the table has printed segments.
    """
    seg = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(values).alias("v"))))
    return rows.groupBy(*part, label).agg(F.min(order).alias(order),
                                          F.flatten(F.transform(seg, lambda s: s["v"])).alias(values))


def version_status(df: DataFrame, family: str, name: str, ts: str, gap: int = 900) -> DataFrame:
    """Current, same working session or superseded, within each family.

    Files saved less than `gap` seconds apart are one session, not a decision.
    """
    head = F.min(F.when(F.col(ts).isNotNull(), F.struct((-F.unix_micros(F.col(ts).cast("timestamp"))).alias("t"), F.col(name).alias("n"))))
    out = df.join(df.groupBy(family).agg(head.alias("_h")), family, "left")
    seconds = F.floor((-F.col("_h")["t"] - F.unix_micros(F.col(ts).cast("timestamp"))) / 1000000)
    status = (F.when(F.col("_h").isNull() | F.col(ts).isNull(), "unknown — no authoring date")
              .when(F.col(name) == F.col("_h")["n"], "CURRENT in its family")
              .when(seconds < gap, "same working session").otherwise("superseded"))
    return out.select(*df.columns, status.alias("status"), F.when(
        status.isin("same working session", "superseded"), F.col("_h")["n"]).alias("head"))


def budget_against_actual(rows: DataFrame, section: str, budget: str, actual: str, printed: str, tol: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """(rows, excluded): the variance with favourable positive, and rows that print another one."""
    derived = F.when(F.col(section) == "revenues", F.col(actual) - F.col(budget)).otherwise(F.col(budget) - F.col(actual))
    out = rows.withColumn("variance_derived", derived)
    wrong = F.coalesce(F.abs(F.round(F.col("variance_derived") - F.col(printed), 4)) >= tol, F.lit(False))
    return out.filter(~wrong), out.filter(wrong)


def vintage(df: DataFrame, keys: list[str], recency: Column, ordinal: str, value: str, source: str) -> DataFrame:
    """First and last reading of one year by document recency.

    The trail between them is `df` itself, ordered by recency.
    """
    one = F.struct(recency.alias("r"), F.col(ordinal).alias("o"), F.col(value).alias("v"), F.col(source).alias("s"))
    return df.groupBy(*keys).agg(F.min(one).alias("_a"), F.max(one).alias("_b"), F.count("*").alias("readings")).select(
        *keys, F.col("_a")["v"].alias("first_value"), F.col("_b")["v"].alias("last_value"), "readings",
        F.concat_ws(" → ", F.col("_a")["s"].cast("string"), F.when(F.col("readings") > 1, F.col("_b")["s"].cast("string"))).alias("trail"))


# A section that says nothing.
EMPTY_PROSE = r"(?i)^(n/?a\.?|none\.?|tbd\.?)$"


def sections(lines: DataFrame, part: list[str], order: list[str], text: str, headings: dict[str, str],
             chunk: str | None = None) -> DataFrame:
    """Lines below the first occurrence of each heading, with the `section` they belong to.

    Any heading ends the section before it; a heading printed again opens nothing new.
    """
    line = strip(F.col(text))
    named = F.coalesce(*[F.when(line.rlike(p), F.lit(n)) for n, p in headings.items()])
    at = F.struct(*([chunk] if chunk else []), *order)
    marked = lines.withColumn("_name", named)
    if chunk is None:
        # A part that paper bounds is one window: its lines need not meet its headings in a join.
        first = F.min(at).over(Window.partitionBy(*part, "_name")) == at
        marked = marked.withColumn("_first", F.when(F.col("_name").isNotNull(), first))
        mark = F.when(F.col("_name").isNotNull(), F.struct(F.col("_first").alias("f"), F.col("_name").alias("n")))
        seen = ordered.carry_forward(marked, part, order, {"_h": mark})
        return seen.filter("_name is null and _h.f").select(*lines.columns, F.col("_h")["n"].alias("section"))
    mark = F.when(F.col("_name").isNotNull(), F.struct(at.alias("at"), F.col("_name").alias("n")))
    seen = ordered.carry_forward(marked, part, order, {"_h": mark}, chunk)
    first = (marked.filter("_name is not null").groupBy(*part, F.col("_name").alias("section"))
             .agg(F.min(at).alias("_at")))
    body = seen.filter("_name is null and _h is not null").select(
        *lines.columns, F.col("_h")["n"].alias("section"), F.col("_h")["at"].alias("_at"))
    return body.join(first, [*part, "section", "_at"], "left_semi").drop("_at")


def section_prose(lines: DataFrame, part: list[str], order: list[str], text: str, headings: dict[str, str],
                  chunk: str | None = None, wanted: list[str] | None = None) -> DataFrame:
    """Prose under each heading, up to the next heading or the end of the part.

    Blank and page-number lines are skipped; "n/a" and the like are null, and so is a
    section without text.
    """
    line = strip(F.col(text))
    body = sections(lines, part, order, text, headings, chunk).withColumn("_t", line)
    body = body.filter((F.col("_t") != "") & ~F.col("_t").rlike(r"^\d{1,4}$"))
    heads = lines.select(*part, F.coalesce(*[F.when(line.rlike(p), F.lit(n)) for n, p in headings.items()]).alias("section")) \
        .filter("section is not null").distinct()
    if wanted:
        body, heads = body.filter(F.col("section").isin(wanted)), heads.filter(F.col("section").isin(wanted))
    place = [F.col(c) for c in ([chunk] if chunk else []) + order]
    prose = body.groupBy(*part, "section").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(F.struct(*place).alias("p"), F.col("_t")))), lambda x: x["_t"]), " ").alias("prose"))
    return heads.join(prose, [*part, "section"], "left").select(
        *part, "section", F.when(~F.col("prose").rlike(EMPTY_PROSE), F.col("prose")).alias("prose"))
