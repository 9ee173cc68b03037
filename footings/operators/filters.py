"""Filters, vocabularies and statuses: what a row is, and whether it may be shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings import vocab
from footings.operators.salting import salted_join, salted_join_many


def lookup(key: Column, table: dict) -> Column:
    """A fixed table as an expression: no join, no shuffle; null where the key is absent."""
    return F.coalesce(*[F.when(key == k, F.lit(v)) for k, v in table.items()])


def facts_for(df: DataFrame, metric: str, low: int | None = None, high: int | None = None,
              metric_col: str = "metric", year_col: str = "fiscal_year") -> DataFrame:
    """One metric; with a year range, rows without a year stay."""
    out = df.filter(F.col(metric_col) == metric)
    if low is not None and high is not None:
        out = out.filter(F.col(year_col).isNull() | F.col(year_col).between(low, high))
    return out


def slice_of(df: DataFrame, **equal) -> DataFrame:
    """Rows whose named columns equal the given values."""
    for name, value in equal.items():
        df = df.filter(F.col(name) == value)
    return df


def publishable(df: DataFrame, value: str, extraction: str, trusted: list[str] | None = None) -> DataFrame:
    """Rows with a figure, obtained in a way that may be published."""
    return df.filter(F.col(extraction).isin(trusted or vocab.PUBLISHABLE) & F.col(value).isNotNull())


def owner_of(df: DataFrame, owners: DataFrame, key: str, owner: str) -> DataFrame:
    """Attach the owner from an explicit table; the rest become ORG_UNKNOWN, for gate G1."""
    return (df.join(owners.select(key, owner), key, "left")
            .withColumn(owner, F.coalesce(F.col(owner), F.lit("ORG_UNKNOWN"))))


def text_layer(images: Column, sampled: Column, fonts: Column, chars_per_page: Column) -> Column:
    """scan, digital or unknown, from what a probe counted on the sampled pages."""
    scanned = images >= F.greatest(F.lit(1), F.floor(sampled * 0.6))
    return (F.when(scanned, "scan").when((fonts > 0) | (chars_per_page > 200), "digital")
            .otherwise("unknown"))


def map_vocab(df: DataFrame, col: str, mapping: dict, out: str) -> tuple[DataFrame, DataFrame]:
    """(mapped rows, violations): a value outside the vocabulary is never given a default."""
    mapped = df.withColumn(out, lookup(F.col(col), mapping))
    return mapped.filter(F.col(out).isNotNull()), mapped.filter(F.col(out).isNull()).drop(out)


def confidence_ceiling(extraction: Column, claimed: Column) -> Column:
    """The weaker of what is claimed and what the extraction supports."""
    ceiling = F.coalesce(lookup(extraction, vocab.CONFIDENCE_CEILING), F.lit("Working"))
    rank = lookup(claimed, vocab.CONFIDENCE_RANK)
    return F.when(rank < lookup(ceiling, vocab.CONFIDENCE_RANK), claimed).otherwise(ceiling)


def source_confidence(authority: Column, layer: Column) -> Column:
    """Who published it comes first, then whether we can read it."""
    return (F.when(F.coalesce(authority, F.lit("")) != "government", "Working")
            .when(layer == "scan", "Pending").otherwise("High"))


def fact_confidence(authority: Column, extraction: Column) -> Column:
    """The same rule for one figure: authority, then how it was obtained."""
    return (F.when(F.coalesce(authority, F.lit("unknown")) != "government", "Working")
            .when(extraction.isin("derived", "ocr-arithmetic-verified"), "Medium").otherwise("High"))


def recurrence(category: Column, table: dict | None = None) -> Column:
    """Recurring, One-Time or Unclassified."""
    return F.coalesce(lookup(category, table or vocab.RECURRENCE), F.lit("Unclassified"))


def coalesce_label(labels: list[Column], qualifier: Column) -> Column:
    """First label present, with its qualifier where that says something else."""
    label = F.coalesce(*labels)
    return F.when(qualifier.isNotNull() & (qualifier != "") & (qualifier != label),
                  F.concat(label, F.lit(" — "), qualifier)).otherwise(label)


def canonical_source(df: DataFrame, source: str, year: str, documents: DataFrame,
                     by_year: DataFrame) -> DataFrame:
    """Resolve a cited key: an exact id, else the document of the year in the key, else as is.

    `documents` holds (id), `by_year` holds (year, document), one row per year.
    """
    key = F.coalesce(F.col(source), F.lit(""))
    printed = F.nullif(F.regexp_extract(key, r"(20\d{2})", 1), F.lit("")).cast("int")
    keyed = df.withColumn("_key", key).withColumn("_year", F.coalesce(printed, F.col(year).cast("int")))
    known = documents.select(F.col("id").alias("_key"), F.lit(True).alias("_known"))
    years = by_year.select(F.col("year").alias("_year"), F.col("document").alias("_document"))
    # Documents may be as many as there are rows; years are few.
    out = salted_join(salted_join_many(keyed, known, ["_key"], "left"), years, ["_year"], "left")
    moved = F.col("_known").isNull() & (F.col("_key") != "") & F.col("_document").isNotNull()
    return (out.withColumn("source_id", F.when(moved, F.col("_document")).otherwise(F.col("_key")))
            .withColumn("source_note", F.when(moved, F.concat(F.lit("register key "), F.col("_key"))))
            .drop("_key", "_year", "_known", "_document"))


def coverage_status(contributed: Column, superseded: Column, extractable: Column, scanned: Column,
                    name: Column, design: list[str], narrative: list[str], cited: Column) -> Column:
    """Why a document does or does not feed the warehouse; ordered rules, citation last.

    A scanned document is told apart from one without figures, so
    `scanned-unextractable` can be reached.
    """
    plain = F.trim(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", " "))

    def hints(words):
        return F.coalesce(*[F.when(plain.contains(w), F.lit(True)) for w in words], F.lit(False))

    readable = F.coalesce(extractable, F.lit(False))
    return (F.when(contributed > 0, "read").when(superseded, "superseded-by-digital")
            .when(~readable & F.coalesce(scanned, F.lit(False)), "scanned-unextractable")
            .when(~readable, "no-figures").when(hints(design), "design-document")
            .when(hints(narrative), "no-figures")
            .when(cited > 0, "read-into-datasets-only").otherwise("not-yet-read"))


def retrieval_status(url: Column, authority: Column, filename: Column) -> Column:
    """How a third party could obtain the document."""
    lower = F.lower(filename)
    on_request = F.coalesce(*[F.when(lower.endswith(s), F.lit(True)) for s in vocab.REQUEST_FORMATS],
                            F.lit(False))
    return (F.when(F.coalesce(url, F.lit("")) != "", "url_recorded")
            .when(F.coalesce(authority, F.lit("")) != "government", "authored_in_house")
            .when(on_request, "supplied_on_request").otherwise("needs_official_url"))


def two_boundaries(df: DataFrame, keys: list[str], member: str, value: Column, broad: list[str],
                   arguable: list[str]) -> DataFrame:
    """Totals of a set with and without its arguable members, beside the whole."""
    inside = F.col(member).isin(broad)
    narrow = inside & ~F.col(member).isin(arguable)
    sums = df.groupBy(*keys).agg(
        F.sum(value).cast("double").alias("total"),
        F.coalesce(F.sum(F.when(inside, value)).cast("double"), F.lit(0.0)).alias("broad"),
        F.coalesce(F.sum(F.when(narrow, value)).cast("double"), F.lit(0.0)).alias("narrow"))
    return sums.select(*keys, "total", "broad", "narrow",
                       F.round(F.try_divide(F.col("broad"), F.col("total")) * 100, 1).alias("broad_pct"),
                       F.round(F.try_divide(F.col("narrow"), F.col("total")) * 100, 1).alias("narrow_pct"))


def export_view(df: DataFrame, spec: dict[str, Column | str]) -> DataFrame:
    """A mart projected to the columns, order and names of one export table."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in spec.items()])


def resolve_unique(refs: DataFrame, source: str, register: DataFrame, files: DataFrame) -> DataFrame:
    """Resolve each cited source to one file: the registered name, else the only file of its year.

    `register` holds (source_id, filename), `files` holds (filename, year).  Several
    files of one year make the reference ambiguous, none makes it unverifiable.
    """
    named = (register.join(files.select("filename").distinct(), "filename")
             .groupBy("source_id").agg(F.min("filename").alias("_named")))
    per_year = files.groupBy(F.col("year").alias("_year")).agg(
        F.count("*").alias("_n"), F.min("filename").alias("_only"))
    year = F.nullif(F.regexp_extract(F.col(source), r"(20\d{2})", 1), F.lit("")).cast("int")
    out = (refs.withColumn("_year", year)
           .join(named.withColumnRenamed("source_id", source), source, "left")
           .join(per_year, "_year", "left"))
    return out.withColumn(
        "resolution", F.when(F.col("_named").isNotNull(), "registered").when(F.col("_n") == 1, "by year")
        .when(F.col("_n") > 1, "ambiguous").otherwise("unverifiable")
    ).withColumn("resolved_file", F.coalesce(F.col("_named"), F.when(F.col("_n") == 1, F.col("_only")))
                 ).drop("_year", "_named", "_n", "_only")


def verdict(value: Column, floor: Column, is_current: Column) -> Column:
    """ok/bad now, watch/bad for a later year; withheld without a floor or a value."""
    above = value >= floor
    return F.when(is_current, F.when(above, "ok").when(~above, "bad")) \
        .otherwise(F.when(above, "watch").when(~above, "bad"))
