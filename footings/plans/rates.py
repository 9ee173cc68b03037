"""Fee schedules and ten-year rate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footings.functions.money import strip
from footings.operators import ordered
from footings.operators.joins import pair_by_identity
from footings.operators.windows import first_ranked
from footings.plans.lineitems import PAGE_BLOCK
from footings.session import stored
from footings.sources.words import to_lines

# How the schedule labels its blocks.
BLOCK1 = r"(?i)Block\s*1\s*\(0-([\d,]+)\s*gallons?/month\)"
BLOCK2 = r"(?i)Block\s*2\s*\(>\s*([\d,]+)\s*gallons?/month\)"
DOLLARS = r"\$\s*([\d,]+\.\d{2})"
SCHEDULE_STARTS, SCHEDULE_ENDS = "Volume Charges", "Capital Facilities Fee"
RATE = r"\$?\s*(\d\s*\.\s*\d{2,6})"
TABLE_YEAR = r"\b(20[012]\d)\b"


def schedule_pages(pages: DataFrame) -> DataFrame:
    """Pages of each document's fee schedule, first to last."""
    text = F.col("text")
    starts = pages.filter(text.contains(SCHEDULE_STARTS)).groupBy("doc_id").agg(F.min("page_no").alias("_from"))
    ends = (pages.filter(text.contains(SCHEDULE_ENDS)).select("doc_id", "page_no").join(starts.hint("merge"), "doc_id")
            .filter("page_no >= _from").groupBy("doc_id").agg(F.min("page_no").alias("_to")))
    # One row per document grows with the documents: merged, not broadcast from the driver.
    return (pages.join(starts.hint("merge"), "doc_id").join(ends.hint("merge"), "doc_id", "left")
            .filter("page_no >= _from and (_to is null or page_no <= _to)").drop("_from", "_to"))


def fee_values(pages: DataFrame) -> DataFrame:
    """(doc_id, service, location, threshold, block, value): every figure a block label may own.

    A figure printed alone belongs to the label above it, to the one below it, or to
    both; the pairing identity decides later.  Service and location carry over pages.
    """
    order, chunk = ["page_no", "line_no"], "_block"
    lines = to_lines(schedule_pages(pages), ["doc_id", "page_no"], "text") \
        .withColumn(chunk, F.floor(F.col("page_no") / PAGE_BLOCK))
    line = F.col("line")
    service = (F.when(line.rlike("(?i)Bulk\\s+Water"), F.struct(F.lit(None).cast("string").alias("v")))
               .when(line.rlike("(?i)Water Volume Charges"), F.struct(F.lit("water").alias("v")))
               .when(line.rlike("(?i)Sewer Volume Charges"), F.struct(F.lit("sewer").alias("v"))))
    opens = line.rlike("(?i)(?:Water|Sewer) Volume Charges")
    place = (F.when(line.rlike(r"(?i)Inside\s+Town"), F.struct(F.lit("inside").alias("v")))
             .when(line.rlike(r"(?i)Outside\s+Town"), F.struct(F.lit("outside").alias("v")))
             .when(opens, F.struct(F.lit(None).cast("string").alias("v"))))
    state = ordered.carry_forward(lines, ["doc_id"], order, {"_service": service, "_place": place}, chunk)
    figures = F.transform(F.regexp_extract_all("line", F.lit(DOLLARS), F.lit(1)),
                          lambda x: F.regexp_replace(x, ",", "").try_cast("double"))
    scoped = F.col("_service")["v"].isNotNull() & F.col("_place")["v"].isNotNull()
    field = F.when(line.rlike(BLOCK1), "block1").when(line.rlike(BLOCK2), "block2")
    gallons = F.coalesce(F.nullif(F.regexp_extract("line", BLOCK1, 1), F.lit("")), F.regexp_extract("line", BLOCK2, 1))
    label = F.struct(F.col("_service")["v"].alias("service"), F.col("_place")["v"].alias("location"),
                     F.regexp_replace(gallons, ",", "").try_cast("int").alias("threshold"), field.alias("block"))
    state = stored(state.select("doc_id", chunk, *order, "line", figures.alias("figures"),
                         F.when(scoped & field.isNotNull(), label).alias("label"),
                         (service.isNotNull() | place.isNotNull()).alias("moves"),
                         (field.isNull() & (F.size(figures) > 0) & line.rlike("[A-Za-z]")).alias("other")))
    nothing = F.struct(F.lit(False).alias("is"), F.lit(None).cast("struct<service:string,location:string,threshold:int,block:string>").alias("l"))
    owner = F.struct(F.lit(True).alias("is"), F.col("label").alias("l"))
    above = F.when(F.col("label").isNotNull(), owner).when(F.col("moves") | F.col("other"), nothing)
    below = F.when(F.col("label").isNotNull(), owner).when(F.col("other"), nothing)
    down = ordered.carry_forward(state, ["doc_id"], order, {"_above": above}, chunk)
    # The same scan backwards finds the label below.
    turned = down.select("*", (-F.col(chunk)).alias("_rblock"), (-F.col("page_no")).alias("_rpage"), (-F.col("line_no")).alias("_rline"))
    both = ordered.carry_forward(turned, ["doc_id"], ["_rpage", "_rline"], {"_below": below}, "_rblock")
    alone = F.col("label").isNull() & (F.size("figures") > 0) & ~F.col("other")
    takers = F.when(F.col("label").isNotNull(), F.array("label")).when(alone, F.array(F.col("_above")["l"], F.col("_below")["l"]))
    owned = both.select("doc_id", "figures", F.explode(F.array_compact(takers)).alias("_l"))
    return owned.select("doc_id", "_l.*", F.explode("figures").alias("value")).distinct()


def rate_sets(values: DataFrame, tol: float = 0.02) -> DataFrame:
    """Current and recommended set per service and location, paired by the block identity."""
    part = ["doc_id", "service", "location", "threshold"]
    one = values.filter("block = 'block1'").select(*part, F.col("value").alias("charge"))
    two = values.filter("block = 'block2'").select(*part, F.col("value").alias("rate"))
    return pair_by_identity(one, two, part, "charge", "rate", F.col("threshold") / 1000.0, tol, 2)


def rate_tables(pages: DataFrame, title: str, rows: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, entity, year, rate) from the pages of a rate table.

    Rows are known by their labels.  A continuation page prints figures
    only: its rows are taken by position, and only if there are exactly as many as the
    table has.  State lasts one page.
    """
    page = ["doc_id", "page_no"]
    lines = to_lines(pages.filter(F.col("text").contains(title)), page, "text")
    rates = F.transform(F.regexp_extract_all("line", F.lit(RATE), F.lit(1)),
                        lambda x: F.regexp_replace(x, r"\s", "").try_cast("double"))
    years = F.transform(F.regexp_extract_all("line", F.lit(TABLE_YEAR), F.lit(1)), lambda x: x.cast("int"))
    lines = lines.withColumn("rates", rates).withColumn("years", years)
    heads = lines.filter((F.size("years") >= 4) & (F.size("rates") == 0)).groupBy(*page).agg(
        F.min(F.struct("line_no", "years")).alias("_head"))
    body = lines.join(heads, page).filter((F.col("line_no") > F.col("_head")["line_no"]) & (F.size("rates") > 0))
    labelled = F.col("line").rlike("[A-Za-z]")
    counts = body.groupBy(*page).agg(F.count("*").alias("_n"), F.bool_or(labelled).alias("_labelled"))
    # The printed label is compared whole; where one is cut short, it must fit one entity only.
    printed = strip(F.regexp_extract("line", r"^([^\d$]*)", 1))
    fits = F.array_compact(F.array(*[F.when((printed != "") & (printed.startswith(text) | F.lit(text).startswith(printed)), key)
                                     for key, text in rows]))
    exact = F.coalesce(*[F.when(printed == text, key) for key, text in rows])
    named = F.coalesce(exact, F.when(F.size(fits) == 1, F.get(fits, F.lit(0))))
    placed = ordered.ordinal(body.select(*page, "line_no", "line", "rates", "_head"), page, ["line_no"], "_i")
    keys = F.array(*[F.lit(k) for k, _ in rows])
    entity = F.when(F.col("_labelled"), named).when(F.col("_n") == len(rows), F.get(keys, (F.col("_i") - 1).cast("int")))
    cells = placed.join(counts, page).withColumn("entity", entity).filter("entity is not null").select(
        *page, "line_no", "entity", F.inline(F.arrays_zip(F.col("_head")["years"].alias("year"), F.col("rates").alias("rate"))))
    cells = cells.filter("year is not null and rate is not null")
    return first_ranked(cells, ["doc_id", "entity", "year"], [F.col("page_no").desc(), F.col("line_no").desc()]) \
        .select("doc_id", "entity", "year", "rate")
