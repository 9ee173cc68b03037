"""Grouped totals, scoreboards, shares and matrices.

Everything here is a partial-then-final aggregation.  Group totals come back to
detail rows through a join with the aggregated frame, never through a window
over a whole group (a printed page is the only one that is small); lists are built only
where their length has a stated bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footings import vocab
from footings.functions.text import classify_first
from footings.operators.filters import recurrence
from footings.operators.joins import money
from footings.operators.windows import first_ranked
from footings.session import spread_pages


def total(col: Column | str) -> Column:
    """Exact sum of money as a double."""
    return F.sum(money(col)).cast("double")


def sum_by(df: DataFrame, keys: list[str], value: str, out: str = "total") -> DataFrame:
    """Sum by keys; nulls are skipped, and a group of nulls sums to null."""
    return df.groupBy(*keys).agg(total(value).alias(out))


def compare_sources(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that several readings report: how many, lowest, highest and their spread.

    The readings themselves are rows of `df`; see `readings_of`.
    """
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    low, high = F.col("lowest"), F.col("highest")
    return (df.groupBy(*keys).agg(F.count("*").alias("readings"), F.min(value).alias("lowest"),
                                  F.max(value).alias("highest"))
            .filter("readings >= 2")
            .withColumn("spread", F.round(high - low, 2))
            .withColumn("spread_pct_of_min", F.round(F.try_divide(
                high - low, F.nullif(F.abs(low), F.lit(0.0))) * 100, 1)))


def readings_of(df: DataFrame, comparisons: DataFrame, keys: list[str]) -> DataFrame:
    """The single readings behind each comparison, one row each."""
    return df.join(comparisons.select(*keys), keys, "left_semi")


def contributions(tables: dict[str, tuple[DataFrame, str]], documents: DataFrame, key: str) -> DataFrame:
    """Rows per document and table, with a total; documents without rows count zero."""
    counts = [df.groupBy(F.col(doc).alias(key)).agg(F.count("*").alias("_n"))
              .withColumn("_t", F.lit(name)) for name, (df, doc) in tables.items()]
    both = reduce(DataFrame.unionByName, counts)
    wide = both.groupBy(key).agg(*[
        F.sum(F.when(F.col("_t") == name, F.col("_n"))).alias(name) for name in tables])
    out = documents.select(key).join(wide, key, "left").na.fill(0, list(tables))
    return out.withColumn("facts_total", sum((F.col(n) for n in tables), F.lit(0)))


def coverage_matrix(df: DataFrame, org: str, year: str, thin: int) -> DataFrame:
    """Every organization × every year seen anywhere, with its count and state.

    The year list is one scalar (fiscal years are few), so the grid is an explode
    over organizations, not a cross join.
    """
    counts = df.groupBy(org, year).agg(F.count("*").alias("facts"))
    years = counts.agg(F.collect_set(year)).scalar()
    grid = counts.select(org).distinct().select(org, F.explode(years).alias(year))
    n = F.coalesce(F.col("facts"), F.lit(0))
    return grid.join(counts, [org, year], "left").select(
        org, year, n.alias("facts"),
        F.when(n == 0, "empty").when(n < thin, "thin").otherwise("covered").alias("state"))


def summary(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Counts and sums under predicates, in one pass."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def cited_documents(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dataset, document) for every document a dataset cites, once."""
    parts = [df.select(F.lit(name).alias("dataset"), F.col(doc).alias("document")).filter("document is not null")
             for name, (df, doc) in tables.items()]
    return reduce(DataFrame.unionByName, parts).distinct()


def evidence_base(cited: DataFrame) -> DataFrame:
    """Per document: how many datasets rest on it."""
    return cited.groupBy("document").agg(F.count("*").alias("datasets"))


def corroborate(df: DataFrame, key: list[str], value: str, edition: str, digits: int = 6) -> DataFrame:
    """A cell agrees when every edition prints one value; otherwise it is disputed.

    Two-level: editions per distinct value, then values per key.
    """
    per_value = (df.filter(F.col(value).isNotNull())
                 .groupBy(*key, F.round(F.col(value), digits).alias("_v"))
                 .agg(F.count("*").alias("_n"), F.min(edition).alias("_first")))
    one = F.count("*") == 1
    return per_value.groupBy(*key).agg(
        F.when(one, F.min("_v")).alias("value"), F.count("*").alias("distinct_values"),
        F.sum("_n").alias("editions"), F.min("_first").alias("first_edition"),
        F.when(one, "agreed").otherwise("disputed").alias("state"))


def verified_slices(checks: DataFrame, keys: list[str], flag: str = "verified") -> DataFrame:
    """A slice verifies only when every check inside it does; an unknown check does not."""
    ok = F.coalesce(F.col(flag), F.lit(False))
    return checks.groupBy(*keys).agg(F.bool_and(ok).alias("verified"), F.count("*").alias("checks"),
                                     F.count_if(ok).alias("reconciled"))


def classify_total(parts: DataFrame, stated: DataFrame, keys: list[str], part: str, total_col: str,
                   tol: float = 1.0, least_parts: int = 5) -> DataFrame:
    """Do the parts make the stated total?  A zero part is treated like an absent one."""
    populated = F.when(F.col(part) != 0, money(part))
    sums = parts.groupBy(*keys).agg(
        F.coalesce(F.sum(populated).cast("double"), F.lit(0.0)).alias("parts_sum"),
        F.count(populated).alias("parts"))
    out = stated.select(*keys, F.col(total_col).alias("stated_total")).join(sums, keys, "left") \
        .na.fill(0, ["parts", "parts_sum"])
    variance = F.round(F.col("parts_sum") - F.col("stated_total"), 2)
    good = F.coalesce(F.abs(variance) <= tol, F.lit(False))
    return out.withColumn("variance", variance).withColumn("reconciles", good).withColumn(
        "state", F.when(good, "reconciles").when(F.col("parts") < least_parts, "components incomplete")
        .otherwise("presentation difference"))


def variance_by(classified: DataFrame, keys: list[str]) -> DataFrame:
    """Per basis: totals seen, how many reconcile, the state counts, the variance range."""
    usable = F.when(F.col("state") != "components incomplete", F.col("variance"))
    return classified.groupBy(*keys).agg(
        F.count("*").alias("totals"), F.count_if("reconciles").alias("reconcile"),
        F.count_if(F.col("state") == "components incomplete").alias("incomplete"),
        F.count_if(F.col("state") == "presentation difference").alias("differ"),
        F.min(usable).alias("variance_low"), F.max(usable).alias("variance_high"))


def shares(parts: DataFrame, keys: list[str], part: str, value: str, gate: DataFrame | None = None,
           flag: str = "reconciles") -> DataFrame:
    """Share of each part in its group's total, published only where the gate holds."""
    detail = parts.groupBy(*keys, part).agg(total(value).alias("amount"))
    whole = parts.groupBy(*keys).agg(total(value).alias("_whole"))
    out = detail.join(whole, keys)
    pct = F.round(F.try_divide(F.col("amount"), F.nullif(F.col("_whole"), F.lit(0.0))) * 100, 2)
    if gate is not None:
        out = out.join(gate.select(*keys, flag), keys, "left")
        pct = F.when(F.coalesce(F.col(flag), F.lit(False)), pct)
    return out.select(*keys, part, "amount", pct.alias("share_pct"))


def fund_shares(parts: DataFrame, keys: list[str], part: str, value: str, stated: DataFrame,
                stated_col: str) -> DataFrame:
    """Width against the sum of the parts; share against the stated total where they agree."""
    detail = parts.groupBy(*keys, part).agg(total(value).alias("amount"))
    whole = parts.groupBy(*keys).agg(total(value).alias("_sum"))
    out = detail.join(whole, keys).join(stated.select(*keys, F.col(stated_col).alias("_stated")), keys, "left")
    agrees = F.coalesce(F.abs(F.col("_sum") - F.col("_stated")) < 1, F.lit(False))
    base = F.when(agrees, F.col("_stated")).otherwise(F.col("_sum"))

    def pct(denominator):
        return F.coalesce(F.try_divide(F.col("amount"), F.nullif(denominator, F.lit(0.0))) * 100, F.lit(0.0))

    return out.select(*keys, part, "amount", agrees.alias("agrees"),
                      F.round(pct(F.col("_sum")), 4).alias("width_pct"), F.round(pct(base), 4).alias("share_pct"),
                      F.when(agrees, "of the total").otherwise("of the parts").alias("label"))


def drill(df: DataFrame, group: str, detail: str, value: str) -> DataFrame:
    """Largest groups first, and inside each the largest details."""
    inner = df.groupBy(group, detail).agg(total(value).alias("detail_total"))
    outer = df.groupBy(group).agg(total(value).alias("group_total"))
    return inner.join(outer, group).orderBy(F.col("group_total").desc(), group,
                                            F.col("detail_total").desc(), detail)


def flow_matrix(df: DataFrame, keys: list[str], src: str, dst: str, value: str, destinations: list[str],
                page: str, doc: str) -> DataFrame:
    """Source × destination money per slice, row totals, documents and page range.

    Rows without money drop.  The destination list is explicit, so no extra job
    looks for it.
    """
    cells = [F.coalesce(F.sum(F.when(F.col(dst) == d, money(value))).cast("double"), F.lit(0.0)).alias(d)
             for d in destinations]
    out = df.groupBy(*keys, src).agg(*cells, F.coalesce(total(value), F.lit(0.0)).alias("total_out"),
                                     F.countDistinct(doc).alias("source_docs"),
                                     F.min(page).alias("first_page"), F.max(page).alias("last_page"))
    return out.filter(F.col("total_out") != 0)


def flow_received(matrix: DataFrame, keys: list[str], destinations: list[str]) -> DataFrame:
    """Received by destination, and transferred in all, per slice."""
    return matrix.groupBy(*keys).agg(*[total(d).alias(d) for d in destinations],
                                     total("total_out").alias("total_transferred"))


def recurrence_split(df: DataFrame, keys: list[str], category: str, value: str,
                     table: dict | None = None) -> DataFrame:
    """Recurring, one-time and unclassified money, and both readings of the recurring share.

    `recurring_pct_of_all` divides by everything, unclassified money included;
    `recurring_pct_of_classified` divides by what was classified.
    """
    kind = recurrence(F.col(category), table)

    def part(name):
        return F.coalesce(F.sum(F.when(kind == name, money(value))).cast("double"), F.lit(0.0))

    sums = df.groupBy(*keys).agg(part("Recurring").alias("recurring"), part("One-Time").alias("one_time"),
                                 part("Unclassified").alias("unclassified"))
    r, o, u = F.col("recurring"), F.col("one_time"), F.col("unclassified")

    def pct(denominator):
        return F.round(F.try_divide(r, F.nullif(denominator, F.lit(0.0))) * 100, 1)

    return sums.withColumn("recurring_pct_of_all", pct(r + o + u)) \
        .withColumn("recurring_pct_of_classified", pct(r + o))


def dimension_coverage(df: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """How far each dimension can be filled, measured in one pass."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count(c).alias(n) for n, c in dims.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).alias("filled")) for n in dims])
    out = counts.select("_all", F.explode(rows).alias("_r")).select(
        F.col("_r")["dimension"].alias("dimension"), F.col("_r")["filled"].alias("filled"), F.col("_all").alias("rows"))
    return out.withColumn("status", F.when(F.col("filled") == 0, "not fillable")
                          .when(F.col("filled") == F.col("rows"), "fully filled").otherwise("partly filled"))


def rollup_projects(df: DataFrame, fund: str, cost: str, recurring: Column) -> DataFrame:
    """Projects, planned cost and how many create recurring cost, per fund."""
    return df.groupBy(F.coalesce(F.col(fund), F.lit("Unstated")).alias("fund")).agg(
        F.count("*").alias("projects"), F.coalesce(total(cost), F.lit(0.0)).alias("total_planned_cost"),
        F.count_if(recurring).alias("create_recurring_cost"))


def multiset_match(truth: DataFrame, got: DataFrame, part: list[str], value: str) -> DataFrame:
    """Per part: how many values of one multiset the other holds, with missed and spurious counts.

    Values are counted on both sides first, so repeated values cost one row each.
    """
    def counted(df, name):
        return df.groupBy(*part, value).agg(F.count("*").alias(name))

    both = counted(truth, "_t").join(counted(got, "_g"), [*part, value], "full_outer") \
        .na.fill(0, ["_t", "_g"])
    sums = both.groupBy(*part).agg(
        F.sum("_t").alias("truth"), F.sum("_g").alias("got"), F.sum(F.least("_t", "_g")).alias("matched"),
        F.sum(F.greatest(F.col("_t") - F.col("_g"), F.lit(0))).alias("missed"),
        F.sum(F.greatest(F.col("_g") - F.col("_t"), F.lit(0))).alias("spurious"))
    return precision_recall(sums)


def precision_recall(sums: DataFrame) -> DataFrame:
    """Recall and precision in per cent, zero where there is nothing to find."""
    def pct(n):
        return F.round(F.coalesce(F.try_divide(F.col("matched") * 100.0, F.nullif(F.col(n), F.lit(0))), F.lit(0.0)), 1)

    return sums.withColumn("recall_pct", pct("truth")).withColumn("precision_pct", pct("got"))


def overall_match(per_part: DataFrame) -> DataFrame:
    """All parts together."""
    return precision_recall(per_part.agg(*[F.sum(c).alias(c) for c in (
        "truth", "got", "matched", "missed", "spurious")]))


def dedupe_by_hash(df: DataFrame, sha: str, name: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(canonical rows, duplicates): per hash the cleanest name, then the first name.

    Copies stay rows of (sha, canonical, duplicate): a hash shared by very many
    copies is never gathered into one list.
    """
    artefact = F.col(name).cast("string").rlike(r"\(\d+\)").cast("int")
    pick = F.min(F.struct(artefact.alias("_a"), F.col(name), *[c for c in columns if c not in (sha, name)]))
    first = df.groupBy(sha).agg(pick.alias("_c"), F.count("*").alias("copies"))
    canonical = first.select(sha, *[F.col("_c")[c].alias(c) for c in dict.fromkeys([name, *columns]) if c != sha], "copies")
    pairs = df.select(sha, F.col(name).alias("duplicate")).join(
        canonical.select(sha, F.col(name).alias("canonical")), sha)
    return canonical, pairs.filter(F.col("duplicate") != F.col("canonical")).select(sha, "canonical", "duplicate")


def choose_best(df: DataFrame, key: str, ident: str, order: list[Column], compare: str) -> DataFrame:
    """The best candidate of each key; losers name the winner and how it compares."""
    best = F.min(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], F.col(ident), F.col(compare)))
    chosen = df.groupBy(key).agg(best.alias("_b"))
    out = df.join(chosen, key)
    won = F.col(ident) == F.col("_b")[ident]
    return out.select(key, ident, compare, won.alias("chosen"),
                      F.when(~won, F.col("_b")[ident]).alias("chosen_instead"),
                      F.when(~won, F.col("_b")[compare]).alias(f"chosen_{compare}"))


def burden(docs: DataFrame, owner: str, name: str, pages: str, examples: int = 3) -> DataFrame:
    """Documents and pages per owner, with the first few names as examples."""
    sums = docs.groupBy(owner).agg(F.count("*").alias("documents"),
                                   F.sum(F.coalesce(F.col(pages), F.lit(0))).alias("pages"))
    few = first_ranked(docs.select(owner, name), [owner], [F.col(name).asc()], examples)
    listed = few.groupBy(owner).agg(F.array_join(F.array_sort(F.collect_list(name)), " | ").alias("examples"))
    return sums.join(listed, owner, "left")


def status_counts(df: DataFrame, owner: str, status: str, statuses: list[str]) -> DataFrame:
    """Rows per owner and status, one column per status."""
    return df.groupBy(owner).agg(*[F.count_if(F.col(status) == s).alias(s) for s in statuses])


SLOPES = (-60, 60, 2000.0)   # fixed values: candidate slopes are i / 2000 for i in −60 … 60
LEAST_WORDS = 12


def estimate_skew(words: DataFrame, part: list[str]) -> DataFrame:
    """(part…, slope): the rotation that concentrates a page's words on fewest lines.

    Pages with too few words are left level.  From one slope to the next few words change their
    line, so only those changes are followed: what they add to the sum of the squared weights of
    all lines, summed up over the slopes, is the score of every slope.  A page's words meet in
    one task, and the trials are never shuffled.
    """
    low, high, scale = SLOPES
    centre_x = (F.col("x0") + F.col("x1")) / 2
    centre_y = (F.col("top") + F.col("bottom")) / 2
    # Widths in hundredths of a point: whole numbers add up the same in any order,
    # so equal scores stay equal and the first slope wins on every run.
    width = F.coalesce(F.round((F.col("x1") - F.col("x0")) * 100).cast("long"), F.lit(0).cast("long"))
    slim = words.select(*part, centre_x.alias("_x"), centre_y.alias("_y"), width.alias("_w"))
    # A page's words are moved once, before every slope repeats them.
    slim = spread_pages(slim, *part)
    tried = slim.select(*part, "_x", "_y", "_w", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("_i"))

    def line(i: Column) -> Column:
        return F.rint(F.col("_y") - i / F.lit(scale) * F.col("_x"))

    moved = tried.select(*part, "_i", "_w", line(F.col("_i")).alias("_to"), line(F.col("_i") - 1).alias("_from")) \
        .filter((F.col("_i") == low) | ~F.col("_to").eqNullSafe(F.col("_from")))
    come = F.struct(F.col("_to").alias("_line"), F.col("_w"))
    go = F.struct(F.col("_from").alias("_line"), (-F.col("_w")).alias("_w"))
    changes = moved.select(*part, "_i", F.inline(F.when(F.col("_i") == low, F.array(come)).otherwise(F.array(come, go))))
    # A line of weight v that grows by w adds w · (2v + w) to the sum of squares; paper bounds the words of a line.
    upto = Window.partitionBy(*part, "_line").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    grown = F.col("_w").cast("decimal(19,0)") * (2 * F.sum("_w").over(upto) - F.col("_w")).cast("decimal(19,0)")
    steps = changes.select(*part, "_i", grown.alias("_g")).groupBy(*part, "_i").agg(
        F.sum("_g").alias("_g"), F.count_if(F.col("_i") == low).alias("_n"))
    # A slope without a change scores as the one before it, which wins the tie.
    page = Window.partitionBy(*part).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    scores = steps.select(*part, "_i", "_n", F.sum("_g").over(page).alias("_s"))
    best = F.max(F.struct(F.col("_s"), (-F.col("_i")).alias("_j")))
    return scores.groupBy(*part).agg(best.alias("_b"), F.max("_n").alias("_n")).select(
        *part, F.when(F.col("_n") >= LEAST_WORDS, -F.col("_b")["_j"] / F.lit(scale)).otherwise(0.0).alias("slope"))


def deskew(words: DataFrame, part: list[str]) -> DataFrame:
    """Words with top and bottom corrected so that a printed line is level."""
    shift = F.col("slope") * ((F.col("x0") + F.col("x1")) / 2)
    return (words.join(estimate_skew(words, part), part)
            .withColumn("top", F.col("top") - shift).withColumn("bottom", F.col("bottom") - shift))


def impact_by_kind(df: DataFrame, key: str, account: str, amounts: str) -> DataFrame:
    """A project's stated budget impact by kind, and the part that recurs."""
    kind = classify_first(F.upper(F.col(account)), vocab.IMPACT_KINDS, vocab.IMPACT_OTHER)
    spent = F.aggregate(F.col(amounts), F.lit(0).cast("decimal(28,2)"),
                        lambda acc, v: (acc + F.coalesce(v, F.lit(0)).cast("decimal(18,2)")).cast("decimal(28,2)"))
    per_kind = df.select(key, kind.alias("kind"), spent.alias("_v")).groupBy(key, "kind").agg(
        F.sum("_v").cast("double").alias("amount"))
    return per_kind.withColumn("recurring", F.col("kind").isin(vocab.IMPACT_RECURRING))


def split_plan(df: DataFrame, keys: list[str], amounts: str, stated: DataFrame, stated_col: str,
               columns: int | None = None) -> DataFrame:
    """Money already appropriated (first column) against the plan years, with a shape check."""
    def dec(v):
        return F.coalesce(v, F.lit(0.0)).cast("decimal(18,2)")

    first = dec(F.try_element_at(F.col(amounts), F.lit(1)))
    rest = F.aggregate(F.slice(F.col(amounts), F.lit(2), F.greatest(F.size(amounts) - 1, F.lit(0))),
                       F.lit(0).cast("decimal(28,2)"), lambda acc, v: (acc + dec(v)).cast("decimal(28,2)"))
    n = F.size(amounts)
    sums = df.groupBy(*keys).agg(F.sum(first).cast("double").alias("already"),
                                 F.sum(rest).cast("double").alias("plan_window"),
                                 F.min(n).alias("_low"), F.max(n).alias("_high"))
    shape = F.col("_low") == F.col("_high")
    if columns is not None:
        shape = shape & (F.col("_low") == columns)
    out = sums.join(stated.select(*keys, F.col(stated_col).alias("_stated")), keys, "left")
    return out.select(*keys, "already", "plan_window", shape.alias("shape_ok"),
                      (F.abs(F.col("already") + F.col("plan_window") - F.col("_stated")) < 1).alias("reconciles"))


def melt(df: DataFrame, keys: list[str], columns: list[str], name: str = "measure",
         value: str = "value") -> DataFrame:
    """Wide to long; a blank is dropped, never published as zero."""
    return df.unpivot(keys, columns, name, value).filter(F.col(value).isNotNull())


def dim_year(fact: DataFrame, year: str, scenario: str) -> DataFrame:
    """The years loaded, their bounds and the scenarios each holds (a closed vocabulary)."""
    y = F.regexp_extract(F.col(year).cast("string"), r"(\d{4})", 1).cast("int")
    return fact.groupBy(year).agg(F.array_join(F.array_sort(F.collect_set(scenario)), ",").alias("scenarios"),
                                  F.count("*").alias("facts")).select(
        year, F.make_date(y - 1, F.lit(7), F.lit(1)).cast("string").alias("starts"),
        F.make_date(y, F.lit(6), F.lit(30)).cast("string").alias("ends"), "scenarios", "facts")


def apportion(df: DataFrame, group: list[str], value: str, amount: str) -> DataFrame:
    """Split an amount over a group's rows in proportion to a value; null when it cannot be."""
    whole = df.groupBy(*group).agg(F.sum(value).alias("_whole"))
    part = F.try_divide(F.nullif(F.col(amount), F.lit(0.0)) * F.col(value), F.nullif(F.col("_whole"), F.lit(0.0)))
    return df.join(whole, group).withColumn("apportioned", part).drop("_whole")


def pivot_checked(df: DataFrame, key: str, field: str, value: str, ordinal: Column,
                  fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(pivot, problems): the last value of each field wins, and two values are reported."""
    cells = df.filter(F.col(field).isin(fields)).groupBy(key, field).agg(
        F.max(F.struct(ordinal.alias("o"), F.col(value).alias("v")))["v"].alias("v"),
        F.min(value).alias("lowest"), F.max(value).alias("highest"))
    wide = cells.groupBy(key).agg(*[F.max(F.when(F.col(field) == f, F.col("v"))).alias(f) for f in fields])
    return wide, cells.filter("lowest <> highest").select(key, field, "lowest", "highest")


def name_index(df: DataFrame, name: str, container: str) -> DataFrame:
    """How many containers hold each name."""
    return df.select(name, container).distinct().groupBy(name).agg(
        F.count("*").alias("containers"), F.min(container).alias("first_container"))
