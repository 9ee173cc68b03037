"""Joins: orphans, reconciliation, comparison of readings, near and fuzzy matches.

Sides are aggregated to one row per key before they meet wherever the meaning
allows, so a hot key is combined map-side; the remaining many-to-one joins keep
the large side on the left, where AQE can split a skewed partition.  No join is
a cross join and none is forced to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings import vocab
from footings.functions.text import norm_key
from footings.operators.filters import lookup
from footings.operators.salting import salted_join


def money(col: Column | str) -> Column:
    """Exact money for sums: addition order cannot change the total.

    What no such amount can hold (NaN, sixteen digits and more before the point) is null
    here and listed by `unreadable_money`.
    """
    return (F.col(col) if isinstance(col, str) else col).try_cast("decimal(18,2)")


def unreadable_money(df: DataFrame, key: list[str], col: str) -> DataFrame:
    """(key…, amount, problem) of amounts that are stated but can not be summed."""
    return df.filter(F.col(col).isNotNull() & money(col).isNull()).select(
        *key, F.col(col).cast("string").alias("amount"), F.lit("amount can not be summed").alias("problem"))


def orphans(facts: DataFrame, dim: DataFrame, key: str | list[str]) -> DataFrame:
    """Facts whose key is not in the dimension."""
    return facts.join(dim, key, "left_anti")


def with_document(facts: DataFrame, documents: DataFrame, key: str, year: str) -> DataFrame:
    """Attach document attributes; a document without a year ranks as year 0."""
    return (facts.join(documents, key, "left")
            .withColumn(year, F.coalesce(F.col(year), F.lit(0))))


def reconcile_published(detail: DataFrame, published: DataFrame, keys: list[str], value: str,
                        tol: float = 10.0, known: DataFrame | None = None,
                        disclosed: DataFrame | None = None) -> DataFrame:
    """Detail sums against published totals, with known and disclosed variances.

    `known` and `disclosed` hold (keys…, amount, why).  Missing detail counts as
    zero.  A disclosed variance passes unverified, and only while its size stays
    within max(tol, 0.1 %) of what was disclosed.
    """
    sums = detail.groupBy(*keys).agg(F.sum(money(value)).cast("double").alias("_got"))
    out = published.select(*keys, F.col(value).alias("published")).join(sums, keys, "left")
    for name, table in (("known", known), ("disclosed", disclosed)):
        if table is None:
            out = (out.withColumn(f"_{name}", F.lit(None).cast("double"))
                   .withColumn(f"_{name}_why", F.lit(None).cast("string")))
        else:
            out = out.join(table.select(*keys, F.col("amount").alias(f"_{name}"),
                                        F.col("why").alias(f"_{name}_why")), keys, "left")
    got = F.coalesce(F.col("_got"), F.lit(0.0))
    diff = F.round(got - F.col("published"), 2)
    near = F.abs(diff) <= tol
    # Float noise of the subtraction is rounded away: 10.00 passes and 10.01 fails.
    off_known = F.abs(F.round(diff - F.col("_known"), 2)) <= tol
    off_disclosed = F.abs(F.round(diff - F.col("_disclosed"), 2)) <= F.greatest(
        F.lit(tol), F.abs(F.col("_disclosed")) * 0.001)
    ok = near | F.coalesce(off_known, F.lit(False))
    open_ok = F.coalesce(off_disclosed, F.lit(False))
    status = (F.when(ok & F.col("_known").isNotNull(), "known source variance").when(ok, "reconciles")
              .when(open_ok, "disclosed, unexplained").otherwise("UNEXPLAINED"))
    return out.select(
        *keys, "published", got.alias("detail_sum"), diff.alias("difference"), ok.alias("reconciles"),
        status.alias("status"), ok.alias("verified"),
        F.when(ok, F.col("_known_why")).when(open_ok, F.col("_disclosed_why")).alias("explanation"))


def first_reading(df: DataFrame, keys: list[str], ordinal: str, value: str) -> DataFrame:
    """One value per key: the first in file order."""
    pick = F.min(F.struct(ordinal, value))
    return df.groupBy(*keys).agg(pick[value].alias(value))


def compare_readings(a: DataFrame, b: DataFrame, keys: list[str], year: str, value: str,
                     ordinal: str, tol: float = 0.5) -> DataFrame:
    """Two independent readings cell by cell, only for years that both hold.

    `outcome` is agree, disagree, only_left or only_right.
    """
    def side(df, name):
        return first_reading(df.filter(F.col(value).isNotNull()), keys, ordinal, value) \
            .withColumnRenamed(value, name)

    both_years = a.select(year).distinct().join(b.select(year).distinct(), year)
    cells = side(a, "left_value").join(side(b, "right_value"), keys, "full_outer")
    outcome = (F.when(F.col("right_value").isNull(), "only_left")
               .when(F.col("left_value").isNull(), "only_right")
               .when(F.abs(F.col("left_value") - F.col("right_value")) < tol, "agree")
               .otherwise("disagree"))
    return cells.join(both_years, year, "left_semi").withColumn("outcome", outcome)


def readings_by_year(cells: DataFrame, year: str) -> DataFrame:
    """Agreement counts per year, and the rate over the cells both sides read."""
    counts = cells.groupBy(year).agg(*[
        F.count_if(F.col("outcome") == o).alias(o)
        for o in ("agree", "disagree", "only_left", "only_right")])
    return counts.withColumn("agreement_pct", F.round(F.try_divide(
        F.col("agree") * 100.0, F.col("agree") + F.col("disagree")), 2))


def authoritative(df: DataFrame, keys: list[str], source: str, kind: str, ordinal: str,
                  rank: dict | None = None) -> DataFrame:
    """Keep each key's rows from its one authoritative source; first wins ties."""
    order = F.coalesce(lookup(F.col(kind), rank or vocab.AUTHORITY_RANK), F.lit(99))
    best = F.min(F.struct(order.alias("r"), F.col(ordinal).alias("o"), F.col(source).alias("s")))
    chosen = df.groupBy(*keys).agg(best["s"].alias("_authority"))
    return df.join(chosen, keys).filter(F.col(source) == F.col("_authority")).drop("_authority")


def exclude_years(df: DataFrame, years: DataFrame, key: str | list[str]) -> DataFrame:
    """Drop rows of years that are already read directly."""
    names = [key] if isinstance(key, str) else key
    return salted_join(df, years.select(*names).distinct(), names, "left_anti")


def ratio_test(a: DataFrame, b: DataFrame, key: str, left: str, right: str, k: float,
               eps: float = 1e-6) -> DataFrame:
    """Ratio of two tables on shared keys, and whether it is exactly k."""
    ratio = F.try_divide(F.col(left), F.nullif(F.col(right), F.lit(0.0)))
    return a.join(b, key).select(
        key, left, right, F.round(ratio, 6).alias("ratio"),
        F.coalesce(F.abs(ratio - k) < eps, F.lit(False)).alias("exact"))


def all_proven(tests: DataFrame, flag: str = "exact") -> DataFrame:
    """One row: does every shared key pass?  No rows prove nothing."""
    return tests.agg(F.coalesce(F.bool_and(flag), F.lit(False)).alias("proven"),
                     F.count("*").alias("tested"))


def merge_series(series: dict[str, DataFrame], key: str, combine: list[str],
                 fallbacks: dict[str, str] | None = None) -> DataFrame:
    """Several one-row-per-key series side by side, with a combined value.

    Each frame holds (key, value).  `fallbacks` maps a series to the one that fills
    its gaps.  The combined value exists only when every part of `combine` does; a
    row with only some of them is labelled incomplete.  Zero is a value, not a gap.
    """
    out = None
    for name, df in series.items():
        one = df.select(key, F.col("value").alias(name))
        out = one if out is None else out.join(one, key, "full_outer")
    for name, other in (fallbacks or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.col(other)))
    parts = [F.col(c) for c in combine]
    total = sum(parts[1:], parts[0])
    some = F.coalesce(*parts).isNotNull()
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in combine])
    return (out.withColumn("combined", F.round(total, 6))
            .withColumn("incomplete", F.when(total.isNull() & some, F.concat(F.lit("no "), missing))))


def verify_on_page(rows: DataFrame, page_figures: DataFrame, row_key: list[str], page: list[str],
                   figures: str) -> DataFrame:
    """Does every non-zero figure of a row occur on the page it cites?

    `rows` carries an array of figures, `page_figures` one row per figure of a page.
    Compared as whole dollars without sign.  A row without figures, or citing a page
    nobody read, is unverifiable.
    """
    whole = F.bround(F.abs(F.col("_figure")), 0)
    wanted = rows.select(*row_key, *page, F.explode_outer(figures).alias("_figure")) \
        .withColumn("_figure", whole)
    wanted = wanted.withColumn("_figure", F.when(F.col("_figure") != 0, F.col("_figure")))
    printed = page_figures.select(*page, F.bround(F.abs(F.col("figure")), 0).alias("_figure"),
                                  F.lit(True).alias("_hit")).distinct()
    read = page_figures.select(*page).distinct().withColumn("_read", F.lit(True))
    joined = wanted.join(printed, [*page, "_figure"], "left").join(read, page, "left")
    missed = F.col("_figure").isNotNull() & F.col("_hit").isNull()
    out = joined.groupBy(*row_key).agg(
        F.count("_figure").alias("figures"), F.count_if(missed).alias("not_found"),
        F.max(F.when(missed, F.col("_figure"))).alias("largest_missing"),
        F.bool_or(F.coalesce(F.col("_read"), F.lit(False))).alias("_read"))
    checkable = F.col("_read") & (F.col("figures") > 0)
    return out.select(
        *row_key, "figures",
        F.when(~checkable, "unverifiable").when(F.col("not_found") > 0, "NOT FOUND on the cited page")
        .otherwise("every figure found").alias("verification"),
        F.when(checkable, F.col("not_found")).alias("not_found"),
        F.when(checkable, F.col("largest_missing")).alias("largest_missing"))


def corroborate_values(rows: DataFrame, published: DataFrame, row_key: list[str], year: str,
                       values: list[str], value: str, floor: float = 0.0) -> DataFrame:
    """Per row: how many of its figures, of `floor` or more, were published for the same year.

    Rows without such a figure are kept with nothing checked.
    """
    long = rows.select(*row_key, year, F.explode_outer(F.array(*values)).alias("_v")) \
        .withColumn("_v", F.when(F.abs("_v") >= floor, F.round(F.abs("_v"), 2)))
    known = published.select(year, F.round(F.abs(F.col(value)), 2).alias("_v")).distinct() \
        .withColumn("_hit", F.lit(True))
    return long.join(known, [year, "_v"], "left").groupBy(*row_key).agg(
        F.count("_v").alias("checked"), F.count("_hit").alias("corroborated"))


def near_join(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str,
              tol: float) -> DataFrame:
    """Pairs with equal keys and |a − b| ≤ tol, through equal buckets of the value.

    Buckets are 2·tol wide, so partners lie in the same or a neighbouring bucket:
    the left side is copied three times and nothing else is paired.
    """
    def bucket(c):
        return F.floor(F.col(c) / F.lit(2.0 * tol))

    spread = left.withColumn("_near", F.explode(F.sequence(bucket(a) - 1, bucket(a) + 1)))
    # A hair of slack absorbs binary rounding at the very edge of the tolerance.
    return (spread.join(right.withColumn("_near", bucket(b)), [*keys, "_near"])
            .filter(F.abs(F.col(a) - F.col(b)) <= tol + 1e-9).drop("_near"))


def match_total(rows: DataFrame, totals: DataFrame, keys: list[str], row_key: str, amount: str,
                total: str, ordinal: str, cite: list[str], tol: float = 0.005) -> DataFrame:
    """Find each row's amount among the printed totals; keep the first hit's citation.

    Copies of one total are reduced to their first before the join.
    """
    first = totals.groupBy(*keys, total).agg(F.min(F.struct(ordinal, *cite)).alias("_cite"))
    hits = near_join(rows.select(row_key, *keys, amount), first, keys, amount, total, tol) \
        .filter(F.abs(F.col(amount) - F.col(total)) < tol)
    best = hits.groupBy(row_key).agg(F.min("_cite").alias("_cite"))
    out = rows.join(best, row_key, "left")
    return out.select(*rows.columns, F.col("_cite").isNotNull().alias("found"),
                      *[F.col("_cite")[c].alias(f"found_{c}") for c in cite])


def assign_nearest(points: DataFrame, edges: DataFrame, part: list[str], row: str, order: str,
                   x: str, column: str, edge: str, tol: float) -> DataFrame:
    """Put each figure in the nearest column edge within tol; a taken column rejects the next.

    `points` holds (part…, row, order, x), `edges` (part…, column, edge).  `assigned`
    is null for a figure that matches no column or arrives second.
    """
    key = [*part, row, order]
    near = near_join(points.select(*key, x), edges.select(*part, column, edge), part, x, edge, tol)
    nearest = F.min(F.struct(F.abs(F.col(x) - F.col(edge)).alias("d"), F.col(column).alias("c")))
    best = near.groupBy(*key).agg(nearest["c"].alias("_column"))
    first = best.groupBy(*part, row, "_column").agg(F.min(order).alias(order))
    placed = first.select(*key, F.col("_column").alias("assigned"))
    return points.join(placed, key, "left")


def pair_by_identity(a: DataFrame, b: DataFrame, part: list[str], v1: str, v2: str, k: float | Column,
                     tol: float = 0.02, expect: int = 2) -> DataFrame:
    """Pairs with |v1 − v2·k| ≤ tol per group; only a group with exactly `expect` pairs passes.

    The pairs are ordered by v2: the smaller is current, the larger recommended.
    Values are made distinct first, and pairs meet through value buckets.
    """
    left = a.select(*part, v1).distinct()
    right = b.select(*part, v2).distinct().withColumn("_implied", F.col(v2) * k)
    pairs = near_join(left, right, part, v1, "_implied", tol)
    low, high = F.min(F.struct(v2, v1)), F.max(F.struct(v2, v1))
    out = pairs.groupBy(*part).agg(
        F.count("*").alias("pairs"), low[v2].alias("current_rate"), low[v1].alias("current_charge"),
        high[v2].alias("recommended_rate"), high[v1].alias("recommended_charge"))
    exact = F.col("pairs") == expect
    return out.select(*part, "pairs", exact.alias("accepted"), *[
        F.when(exact, F.col(c)).alias(c)
        for c in ("current_rate", "current_charge", "recommended_rate", "recommended_charge")],
        F.when(exact, F.round((F.try_divide(F.col("recommended_rate"), F.col("current_rate")) - 1)
                              * 100, 2)).alias("increase_pct"))


GRAM = 9   # a short name counts as discussed only from nine characters on


def _token_matches(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(name, ordinal, score) with |A∩B| ÷ min(|A|,|B|) ≥ threshold, exactly.

    Prefix filter: the smaller set must share one of its |S| − ⌈t·|S|⌉ + 1 rarest
    tokens with the larger one.  Rare-first order keeps a token found in a third of
    all names out of the join unless a name has nothing rarer.
    """
    def exploded(df, key):
        return df.select(key, "tokens", F.explode("tokens").alias("token"))

    a, b = exploded(left, "name"), exploded(right, "ordinal")
    frequency = (a.select("token").unionByName(b.select("token")).groupBy("token")
                 .agg(F.count("*").alias("df")))

    def prefix(df, key):
        ranked = (df.join(frequency, "token").groupBy(key).agg(
            F.sort_array(F.collect_list(F.struct("df", "token"))).alias("_t"),
            F.first("tokens").alias("tokens")))
        keep = F.size("_t") - F.ceil(F.size("_t") * threshold).cast("int") + 1
        return ranked.select(key, "tokens", F.explode(F.slice("_t", F.lit(1), keep)).alias("_p")) \
            .select(key, "tokens", F.col("_p")["token"].alias("token"))

    a = a.withColumnRenamed("tokens", "left_tokens")
    b = b.withColumnRenamed("tokens", "right_tokens")
    pa = prefix(exploded(left, "name"), "name").withColumnRenamed("tokens", "left_tokens")
    pb = prefix(exploded(right, "ordinal"), "ordinal").withColumnRenamed("tokens", "right_tokens")
    small_left = pa.join(b, "token").filter(F.size("left_tokens") <= F.size("right_tokens"))
    small_right = a.join(pb, "token").filter(F.size("left_tokens") > F.size("right_tokens"))
    cols = ["name", "ordinal", "left_tokens", "right_tokens"]
    shared = F.size(F.array_intersect("left_tokens", "right_tokens"))
    score = shared / F.least(F.size("left_tokens"), F.size("right_tokens"))
    return (small_left.select(*cols).unionByName(small_right.select(*cols)).distinct()
            .select("name", "ordinal", score.alias("score")).filter(F.col("score") >= threshold))


def _grams(text: Column) -> Column:
    n = F.length(text) - (GRAM - 1)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                        lambda i: F.substring(text, i, F.lit(GRAM))))


def _prose_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(name, ordinal): the short name occurs inside the prose, found through shared grams.

    A text containing the name contains every nine-letter gram of it, so joining on
    the name's rarest gram loses nothing; containment is then tested in full.
    """
    names = left.filter(F.length("short") >= GRAM).select("name", "short")
    prose = right.filter(F.length("prose") >= GRAM).select("ordinal", "prose")
    grams = prose.select("ordinal", F.explode(_grams(F.col("prose"))).alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count("*").alias("df"))
    rarest = (names.select("name", "short", F.explode(_grams(F.col("short"))).alias("gram"))
              .join(frequency, "gram").groupBy("name", "short")
              .agg(F.min(F.struct("df", "gram")).alias("_g"))
              .select("name", "short", F.col("_g")["gram"].alias("gram")))
    return (rarest.join(grams, "gram").join(prose, "ordinal")
            .filter(F.col("prose").contains(F.col("short"))).select("name", "ordinal"))


def match_names(left: DataFrame, right: DataFrame, name: str, right_name: str, prose: str,
                ordinal: str, tokenise, threshold: float = 0.75) -> DataFrame:
    """Tiered name match: exact key, then shared words, then named inside the other's prose.

    Every distinct name is matched once, however many rows carry it, and the result
    is joined back: (left columns…, matched_ordinal, basis, score).  Within a tier
    the best score wins and the first form breaks ties.
    """
    short = F.lower(F.trim(F.regexp_replace(F.col("name"), r"\s*-\s*.*$", "")))
    names = (left.select(F.col(name).alias("name")).distinct()
             .withColumn("key", norm_key(F.col("name"))).withColumn("short", short)
             .withColumn("tokens", tokenise(F.col("name"))))
    forms = (right.select(F.col(right_name).alias("form"), F.lower(F.col(prose)).alias("prose"),
                          F.col(ordinal).alias("ordinal"))
             .withColumn("key", norm_key(F.col("form"))).withColumn("tokens", tokenise(F.col("form"))))
    by_key = forms.groupBy("key").agg(F.min("ordinal").alias("ordinal"))
    # Equal token sets and equal proses are interchangeable: the first form stands for all.
    by_tokens = (forms.filter(F.size("tokens") > 0)
                 .groupBy(F.array_sort("tokens").alias("tokens")).agg(F.min("ordinal").alias("ordinal")))
    by_prose = forms.groupBy("prose").agg(F.min("ordinal").alias("ordinal"))

    exact = names.join(by_key, "key").select("name", "ordinal", F.lit(1).alias("tier"), F.lit(1.0).alias("score"))
    rest = names.filter(F.size("tokens") > 0)
    words = _token_matches(rest.select("name", "tokens"), by_tokens.select("ordinal", "tokens"), threshold) \
        .select("name", "ordinal", F.lit(2).alias("tier"), "score")
    inside = _prose_matches(names, by_prose).select("name", "ordinal", F.lit(3).alias("tier"),
                                                    F.lit(0.0).alias("score"))
    pick = F.min(F.struct(F.col("tier"), (-F.col("score")).alias("s"), F.col("ordinal")))
    best = exact.unionByName(words).unionByName(inside).groupBy("name").agg(pick.alias("_m"))
    out = left.join(best.withColumnRenamed("name", name), name, "left")
    tier = F.col("_m")["tier"]
    return out.select(
        *left.columns, F.col("_m")["ordinal"].alias("matched_ordinal"),
        F.when(tier == 1, "exact name").when(tier == 2, "name variant")
        .when(tier == 3, "discussed within the form").otherwise("no form found").alias("basis"),
        F.when(tier <= 2, -F.col("_m")["s"]).alias("score"))


def diff_snapshots(old: DataFrame, new: DataFrame, key: str, sha: str) -> DataFrame:
    """added / removed / changed / unchanged for every key on either side."""
    a = old.select(key, F.col(sha).alias("_old"), F.lit(True).alias("_was"))
    b = new.select(key, F.col(sha).alias("_new"), F.lit(True).alias("_is"))
    change = (F.when(F.col("_was").isNull(), "added").when(F.col("_is").isNull(), "removed")
              .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("changed"))
    return a.join(b, key, "full_outer").select(key, change.alias("change"))


def at_risk(diff: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """How many facts cite a document that changed or went away."""
    moved = diff.filter(F.col("change").isin("changed", "removed")).select(key)
    return facts.join(moved, key, "left_semi").groupBy(key).agg(F.count("*").alias("facts_at_risk"))


def cross_total(published: DataFrame, audited: DataFrame, keys: list[str], value: str,
                adjust: Column, tol: float = 2.0) -> DataFrame:
    """Published sums less an adjustment, against the other document's total."""
    sums = published.groupBy(*keys).agg(
        F.sum(money(value)).cast("double").alias("published"),
        F.coalesce(F.sum(F.when(adjust, money(value))).cast("double"), F.lit(0.0)).alias("adjustment"))
    totals = audited.groupBy(*keys).agg(F.sum(money(value)).cast("double").alias("audited"))
    diff = F.round(F.col("published") - F.col("adjustment") - F.col("audited"), 2)
    return sums.join(totals, keys).withColumn("difference", diff) \
        .withColumn("agree", F.abs(F.col("difference")) <= tol)


def compare_workbook(theirs: DataFrame, facts: DataFrame, keys: list[str], value: str,
                     order: list[Column], is_pct: Column | None = None) -> DataFrame:
    """A workbook's figures against the best reading held, and how many readings there are.

    `order` ranks the readings.  A percentage typed as a ratio is scaled.
    """
    ranked = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)], F.col(value).alias("v"))
    mine = facts.groupBy(*keys).agg(
        F.min(ranked)["v"].alias("ours"), F.count("*").alias("readings"),
        F.min(value).alias("lowest"), F.max(value).alias("highest"))
    joined = theirs.select(*keys, F.col(value).alias("theirs")).join(mine, keys)
    scaled = F.col("theirs") if is_pct is None else \
        F.when(is_pct & (F.col("theirs") < 5), F.col("theirs") * 100).otherwise(F.col("theirs"))
    diff = F.col("theirs") - F.col("ours")
    return (joined.withColumn("theirs", scaled)
            .withColumn("difference", F.round(diff, 2))
            .withColumn("agrees", F.abs(diff) <= F.greatest(F.lit(1.0), F.abs("ours") * 0.005))
            .withColumn("documents_disagree", F.col("readings") > 1))


def route_statement_lines(lines: DataFrame, keys: list[str], year: str, values: str = "values",
                          roles: str = "column_roles", subtotal: str = "is_subtotal",
                          routes: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(financial rows, statement rows): a proven figure of known role, or of unknown role.

    `roles` maps the column index, as text, to its role.  The derived variance column
    loads nowhere; a comparative prior-year column belongs to the year before.
    """
    table = routes or vocab.ROLE_ROUTES
    cells = lines.select(*keys, year, subtotal, roles, F.posexplode(values).alias("column_index", "amount")) \
        .filter(F.col("amount").isNotNull())
    unknown = F.col(roles).isNull() | (F.size(F.col(roles)) == 0)
    role = F.try_element_at(F.col(roles), F.col("column_index").cast("string"))
    known = cells.filter(~unknown).withColumn("role", role).filter(F.col("role").isin(list(table)))
    measure = lookup(F.col("role"), {r: m for r, (_, m, _) in table.items()})
    measure = F.when(F.col(subtotal), F.regexp_replace(measure, "^amount", "fund_total")).otherwise(measure)
    back = lookup(F.col("role"), {r: b for r, (_, _, b) in table.items()})
    financial = known.select(
        *keys, (F.col(year) - back).alias(year), "role",
        lookup(F.col("role"), {r: s for r, (s, _, _) in table.items()}).alias("scenario"),
        measure.alias("measure"), "column_index", "amount")
    return financial, cells.filter(unknown).select(*keys, year, subtotal, "column_index", "amount")


def overlay(base: DataFrame, preferred: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A preferred source replaces the base per key; what stays blank is counted."""
    a = base.select(key, *[F.col(c).alias(f"_base_{c}") for c in columns])
    b = preferred.select(key, *[F.col(c).alias(f"_best_{c}") for c in columns], F.lit(True).alias("_best"))
    taken = F.col("_best").isNotNull()
    merged = a.join(b, key, "full_outer").select(
        key, F.when(taken, "preferred").otherwise("base").alias("how"),
        *[F.when(taken, F.col(f"_best_{c}")).otherwise(F.col(f"_base_{c}")).alias(c) for c in columns])
    blanks = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return merged.withColumn("blanks", blanks)


def timeline(latest: DataFrame, metric: str, year: str, value: str, main: str, gap: str, level: str,
             from_year: int, flag_above: float = 8.0, scenario: DataFrame | None = None) -> DataFrame:
    """One row per year from the headline year on: main metric, its gap and level, and a flag.

    `latest` holds one reading per (metric, year).  A scenario is attached only to the
    row of its own year.
    """
    def pick(name):
        return F.max(F.when(F.col(metric) == name, F.col(value)))

    rows = (latest.filter(F.col(metric).isin(main, gap, level)).groupBy(year)
            .agg(pick(main).alias("main"), pick(gap).alias("gap"), pick(level).alias("level"))
            .filter(F.col("main").isNotNull() & (F.col(year) >= from_year)))
    flagged = rows.withColumn("flag", (F.col("main") < 0)
                              & (F.abs(F.coalesce(F.col("gap"), F.lit(0.0))) > flag_above))
    return flagged if scenario is None else flagged.join(scenario, year, "left")


def pivot_sections(df: DataFrame, year: str, section: str, total: str, ordinal: str,
                   sections: list[str], cite: list[str]) -> DataFrame:
    """Totals by section on one row per year; the last reading in file order wins."""
    def last(condition, col):
        return F.max(F.when(condition, F.struct(F.col(ordinal), F.col(col).alias("v"))))["v"]

    return df.groupBy(year).agg(
        *[last(F.col(section) == s, total).alias(s) for s in sections],
        *[last(F.lit(True), c).alias(c) for c in cite])
