"""Quality gates: violations as a table, and one action that stops a build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings import vocab
from footings.operators import ordered
from footings.operators.filters import confidence_ceiling, lookup


class GateFailed(Exception):
    """A build with violations; the message carries the first of them."""


def violation(df: DataFrame, gate: str, where: Column, problem: Column) -> DataFrame:
    """The common shape of every violation: (gate, where, problem)."""
    return df.select(F.lit(gate).alias("gate"), where.cast("string").alias("where"), problem.alias("problem"))


def real_violations(frames: list[DataFrame], allowed: list[str] = ()) -> DataFrame:
    """All violations less those marked INFO or listed as known."""
    merged = reduce(DataFrame.unionByName, frames)
    known = F.coalesce(*[F.when(F.col("problem").contains(a), F.lit(True)) for a in allowed], F.lit(False))
    return merged.filter(~F.col("problem").rlike(r"\bINFO\b") & ~known)


def failed_checks(checks: DataFrame, where: Column, flags: list[str]) -> DataFrame:
    """Checks that say False; an untestable (null) check passes."""
    bad = F.coalesce(*[F.when(~F.col(f), F.lit(f)) for f in flags])
    return violation(checks.filter(bad.isNotNull()), "checks", where, F.concat(F.lit("failed "), bad))


def gate(violations: DataFrame, shown: int = 20) -> None:
    """Raise when anything is left: the first `shown` violations and how many there are in all."""
    first = violations.limit(shown).collect()
    if first:
        total = violations.count() if len(first) == shown else len(first)
        raise GateFailed("\n".join([f"{total} violations", *(f"{r['gate']} {r['where']}: {r['problem']}" for r in first)]))


def fact_integrity(facts: DataFrame, where: Column, metrics: dict[str, str], documents: DataFrame,
                   metric: str = "metric", source: str = "source_doc", value: str = "value",
                   unit: str = "unit", extraction: str = "extraction", trusted: list[str] | None = None) -> DataFrame:
    """Every rule a fact breaks: unknown metric, unknown source, null value, untrusted, wrong unit.

    `metrics` maps a metric to its unit; `documents` holds the source ids.
    """
    known = documents.select(F.col(documents.columns[0]).alias(source)).distinct().withColumn("_known", F.lit(True))
    want = lookup(F.col(metric), metrics)
    joined = facts.join(known, source, "left")
    broken = F.array_compact(F.array(
        F.when(want.isNull(), F.lit("metric not registered")),
        F.when(F.col("_known").isNull(), F.lit("source not in the manifest")),
        F.when(F.col(value).isNull(), F.lit("null value")),
        F.when(~F.coalesce(F.col(extraction).isin(trusted or vocab.PUBLISHABLE), F.lit(False)), F.lit("extraction not trusted")),
        F.when(want.isNotNull() & ~want.eqNullSafe(F.col(unit)), F.lit("unit differs from the registry"))))
    return joined.select(F.lit("facts").alias("gate"), where.cast("string").alias("where"), F.explode(broken).alias("problem"))


def scan_figures(facts: DataFrame, where: Column, documents: DataFrame, source: str, layer: str = "text_layer",
                 extraction: str = "extraction", direct: str = "digital-text") -> DataFrame:
    """Figures claimed from a scan's own text layer; there must be none."""
    scans = documents.filter(F.col(layer) == "scan").select(source)
    found = facts.filter(F.col(extraction) == direct).join(scans, source, "left_semi")
    return violation(found, "scan", where, F.lit("figure from a scanned text layer"))


def grain_unique(fact: DataFrame, grain: list[str]) -> DataFrame:
    """Grains held by more than one row."""
    dup = fact.groupBy(*grain).agg(F.count("*").alias("_n")).filter("_n > 1")
    return violation(dup, "grain", F.concat_ws("|", *grain), F.concat(F.col("_n").cast("string"), F.lit(" rows at one grain")))


def schema_frozen(df: DataFrame, ddl: str) -> list[str]:
    """Differences between a table and its declared schema; no rows are read."""
    from pyspark.sql.types import StructType

    want = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(ddl)}
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    return sorted(f"{n}: {have.get(n)} instead of {want.get(n)}" for n in want.keys() | have.keys() if want.get(n) != have.get(n))


def owners_present(fact: DataFrame, owner: str, expected: list[str]) -> DataFrame:
    """Expected owners without a single row."""
    seen = fact.agg(*[F.count_if(F.col(owner) == o).alias(o) for o in expected])
    rows = seen.select(F.explode(F.array(*[F.struct(F.lit(o).alias("o"), F.col(f"`{o}`").alias("n")) for o in expected])).alias("_r"))
    return violation(rows.filter("_r.n = 0"), "owners", F.col("_r")["o"], F.lit("no rows loaded"))


def single_source(fact: DataFrame, keys: list[str], source: str) -> DataFrame:
    """Slices that two documents feed."""
    two = fact.groupBy(*keys).agg(F.min(source).alias("_a"), F.max(source).alias("_b")).filter("_a <> _b")
    return violation(two, "source", F.concat_ws("|", *keys), F.concat(
        F.lit("two documents: "), F.col("_a").cast("string"), F.lit(", "), F.col("_b").cast("string")))


def confidence_kept(fact: DataFrame, where: Column, confidence: str, extraction: str) -> DataFrame:
    """Rows whose confidence is above what their extraction supports."""
    ceiling = confidence_ceiling(F.col(extraction), F.lit("High"))
    over = fact.filter(lookup(F.col(confidence), vocab.CONFIDENCE_RANK) > lookup(ceiling, vocab.CONFIDENCE_RANK))
    return violation(over, "confidence", where, F.concat_ws(" ", F.col(confidence), F.lit("from"), F.col(extraction)))


def stale_derived(derived: DataFrame, documents: DataFrame, doc: str, sha: str) -> tuple[DataFrame, DataFrame]:
    """(current rows, violations): recorded content must still be the held content."""
    held = documents.select(doc, F.col(sha).alias("_held"), F.lit(True).alias("_there"))
    out = derived.join(held, doc, "left")
    fresh = F.col("_there").isNotNull() & F.col(sha).eqNullSafe(F.col("_held"))
    bad = violation(out.filter(~fresh), "stale", F.col(doc), F.when(F.col("_there").isNull(), "document is gone")
                    .otherwise("content has changed"))
    return out.filter(fresh).drop("_held", "_there"), bad


def unexplained(reconciled: DataFrame, keys: list[str]) -> DataFrame:
    """Totals whose variance is neither known nor, at its disclosed size, disclosed."""
    return violation(reconciled.filter("status = 'UNEXPLAINED'"), "reconcile", F.concat_ws("|", *keys),
                     F.concat(F.lit("difference "), F.format_string("%.2f", F.col("difference"))))


SLOT_BLOCK = 10000   # suffix numbers per chunk when slots of one name are counted


def assign_ids(documents: DataFrame, registry: DataFrame, sha: str = "sha", slug: str = "slug",
               ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """(sha, id) and violations: an id means one content for ever.

    Known content keeps its id.  The k-th newcomer of a name takes the k-th free slot
    of name, name-2, name-3, …; reaching past a slot owned by content that is not
    held is a violation.  All counting is chunked, so one name shared by very many
    newcomers is numbered by many tasks.
    """
    known = registry.select(sha, ident)
    kept = documents.join(known, sha).select(sha, ident)
    new = documents.join(known, sha, "left_anti").select(sha, slug) \
        .withColumn("_chunk", F.substring(sha, 1, 2))
    new = ordered.ordinal(new, [slug], [sha], "_k", "_chunk")

    held = documents.select(sha).distinct().withColumn("_held", F.lit(True))
    owned = known.join(held, sha, "left")
    suffix = F.regexp_extract(ident, r"-(\d+)$", 1).try_cast("long")
    claims = owned.select(F.explode(F.array_compact(F.array(
        F.struct(F.col(ident).alias("s"), F.lit(1).cast("long").alias("n")),
        F.when(suffix >= 2, F.struct(F.regexp_replace(ident, r"-\d+$", "").alias("s"), suffix.alias("n")))))).alias("_c"),
        "_held").select(F.col("_c")["s"].alias(slug), F.col("_c")["n"].alias("_n"), "_held")
    claims = claims.join(new.select(slug).distinct(), slug, "left_semi") \
        .groupBy(slug, "_n").agg(F.bool_and(F.coalesce("_held", F.lit(False))).alias("_held")) \
        .withColumn("_chunk", F.floor(F.col("_n") / SLOT_BLOCK))
    foreign = claims.filter(~F.col("_held")).groupBy(slug).agg(F.min("_n").alias("_foreign"))

    # Slot of the k-th newcomer: k plus the claimed slots that come before it.
    numbered = ordered.ordinal(claims, [slug], ["_n"], "_i", "_chunk")
    marks = numbered.select(slug, (F.col("_n") - F.col("_i") + 1).alias("_v"), F.lit(0).alias("_kind"), F.lit("").alias(sha)) \
        .unionByName(new.select(slug, F.col("_k").alias("_v"), F.lit(1).alias("_kind"), sha)) \
        .withColumn("_chunk", F.floor(F.col("_v") / SLOT_BLOCK))
    counted = ordered.running_sum(marks, [slug], ["_v", "_kind", sha], (F.col("_kind") == 0).cast("long"),
                                  "_taken", "_chunk")
    slots = counted.filter("_kind = 1").select(sha, slug, (F.col("_v") + F.col("_taken")).alias("_slot")) \
        .join(foreign, slug, "left")
    clash = F.coalesce(F.col("_slot") > F.col("_foreign"), F.lit(False))
    named = F.when(F.col("_slot") == 1, F.col(slug)).otherwise(F.concat_ws("-", slug, F.col("_slot").cast("string")))
    fresh = slots.filter(~clash).select(sha, named.alias(ident))
    bad = violation(slots.filter(clash), "ids", F.col(sha), F.concat(F.lit("ID COLLISION on "), slug))
    return kept.unionByName(fresh), bad
