"""The warehouse: three fact tables through one constructor each, gates, and a repeatable publication.

Stages hand in loads; nothing else makes a fact.  What breaks a rule is a violation, and a
build with violations is not published.  Publishing writes only partitions whose content is
new, each into a folder named by its content, and then one manifest that says which folders
are current: a reader never sees half a build, and a rerun on unchanged content writes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footings import schemas, vocab
from footings.operators import gates
from footings.operators.filters import canonical_source, coalesce_label, confidence_ceiling, lookup
from footings.operators.joins import exclude_years
from footings.operators.salting import salted_join
from footings.operators.windows import grain_ordinal

# A load: the columns of a financial fact but for its Line, whether the source may print a
# grain twice, and the printed order.
LOAD = ("Organization_ID string, Fiscal_Year int, Scenario string, Fund_ID string, Flow string, Department string, "
        "Account string, Category string, Measure string, Amount double, Source_ID string, Source_Detail string, "
        "Source_Page int, Confidence string, Extraction string, repeatable boolean, printed bigint")


def merged_loads(loads: list[DataFrame]) -> DataFrame:
    """All loads in the columns of LOAD; a load that lacks one fails."""
    names = [f.name for f in StructType.fromDDL(LOAD)]
    typed = [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in StructType.fromDDL(LOAD)]
    return reduce(DataFrame.unionByName, [load.selectExpr(*typed).select(*names) for load in loads])


def financial_facts(loads: list[DataFrame], documents: DataFrame, by_year: DataFrame, digital: DataFrame,
                    recognised: str = "ocr-arithmetic-verified", chunk: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(Fact_Financial, violations) of all loads.

    * A row without an amount is no fact.  A recognised figure of an (Organization_ID,
      Fiscal_Year) in `digital` is left out: that year is read directly.
    * `documents` holds (id); a key that is none is resolved by `by_year` (year, document), and
      the key itself stays in Source_Detail.  What still resolves to nothing is a violation.
    * Scenario and flow come from fixed vocabularies; others are violations, never a default.
    * Line numbers what a repeatable source prints more than once, in printed order; any other
      second row of a grain is a violation.  `chunk` splits the numbering of large grains.
    """
    rows = merged_loads(loads).filter(F.col("Amount").isNotNull())
    direct = rows.filter(~F.col("Extraction").eqNullSafe(F.lit(recognised)))
    kept = direct.unionByName(exclude_years(rows.filter(F.col("Extraction") == recognised), digital, ["Organization_ID", "Fiscal_Year"]))
    sourced = canonical_source(kept, "Source_ID", "Fiscal_Year", documents, by_year)
    detail = F.concat_ws("; ", "Source_Detail", "source_note")
    sourced = sourced.withColumn("Source_ID", F.col("source_id")).withColumn("Source_Detail", detail).drop("source_note")
    sourced = sourced.withColumn("Fiscal_Year_ID", F.concat(F.lit("FY"), F.col("Fiscal_Year").cast("string"))) \
        .withColumn("Confidence", confidence_ceiling(F.col("Extraction"), F.col("Confidence"))) \
        .withColumn("Amount", F.round(F.col("Amount").cast("decimal(20,4)"), 2).cast("double"))
    where = F.concat_ws("|", *schemas.GRAIN)
    known = documents.select(F.col("id").alias("Source_ID")).distinct()
    problems = [
        gates.violation(sourced.filter(~F.coalesce(F.col("Scenario").isin(vocab.SCENARIOS), F.lit(False))), "scenario", where, _said("unknown scenario", "Scenario")),
        gates.violation(sourced.filter(~F.coalesce(F.col("Flow").isin(vocab.FLOWS), F.lit(False))), "flow", where, _said("unknown flow", "Flow")),
        gates.violation(sourced.join(known, "Source_ID", "left_anti"), "source", where, _said("document not in the archive", "Source_ID")),
    ]
    good = sourced.filter(F.col("Scenario").isin(vocab.SCENARIOS) & F.col("Flow").isin(vocab.FLOWS))
    numbered, clash = grain_ordinal(good, schemas.GRAIN, ["printed"], F.col("repeatable"), "Line", chunk)
    problems.append(gates.violation(clash, "grain", where, F.concat(F.col("rows").cast("string"), F.lit(" rows at one grain"))))
    return typed(numbered, schemas.FACT_FINANCIAL), reduce(DataFrame.unionByName, problems)


def _said(what: str, column: str) -> Column:
    return F.concat(F.lit(what + " "), F.coalesce(F.col(column), F.lit("null")))


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """The declared columns in their declared order and types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])


def metric_facts(rows: DataFrame, documents: DataFrame, by_year: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(Fact_Metric, violations): figures that are not fund dollars, each with its unit.

    `rows` holds the columns of Fact_Metric with Fiscal_Year for its id, and Qualifier.  A row
    without a metric or an amount is a violation, and so is an unknown document.
    """
    where = F.concat_ws("|", "Organization_ID", "Fiscal_Year", "Metric")
    empty = gates.violation(rows.filter(F.col("Metric").isNull() | F.col("Amount").isNull()), "metric", where, F.lit("row without a metric or an amount"))
    full = canonical_source(rows.filter(F.col("Metric").isNotNull() & F.col("Amount").isNotNull()), "Source_ID", "Fiscal_Year", documents, by_year)
    out = full.withColumn("Source_ID", F.col("source_id")).withColumn("Source_Detail", F.concat_ws("; ", "Source_Detail", "source_note")) \
        .withColumn("Metric", coalesce_label([F.col("Metric")], F.col("Qualifier"))) \
        .withColumn("Unit", F.coalesce("Unit", F.lit("Dollars"))) \
        .withColumn("Fiscal_Year_ID", F.concat(F.lit("FY"), F.col("Fiscal_Year").cast("string"))) \
        .withColumn("Confidence", confidence_ceiling(F.col("Extraction"), F.col("Confidence")))
    stray = out.filter(F.coalesce("Source_ID", F.lit("")) != "").join(documents.select(F.col("id").alias("Source_ID")).distinct(), "Source_ID", "left_anti")
    unknown = gates.violation(stray, "source", where, _said("document not in the archive", "Source_ID"))
    return typed(out, schemas.FACT_METRIC), empty.unionByName(unknown)


def routed_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loads, Fact_Statement_Line) of verified statement lines, one row per figure.

    `lines` holds Organization_ID, fiscal_year, statement, statement_key, flow, group, line,
    column_index, value, role, is_subtotal, doc_id, page_no, verified_by, extraction, fund_id.
    A figure whose column role is known goes to the scenario, measure and year of that role; a
    variance is derived and goes nowhere; a figure without a role keeps its place in the
    statement, with the reason.
    """
    route = lookup(F.col("role"), {k: "|".join(map(str, v)) for k, v in vocab.ROLE_ROUTES.items()})
    parts = F.split("_route", r"\|")
    cells = lines.filter(F.col("value").isNotNull()).withColumn("_route", route)
    total = F.when(F.col("is_subtotal"), F.regexp_replace(parts[1], "^amount", "fund_total")).otherwise(parts[1])
    loads = cells.filter(F.col("_route").isNotNull()).select(
        "Organization_ID", (F.col("fiscal_year") - parts[2].cast("int")).alias("Fiscal_Year"), parts[0].alias("Scenario"),
        F.col("fund_id").alias("Fund_ID"), F.col("flow").alias("Flow"), F.col("statement").alias("Department"), F.col("line").alias("Account"),
        F.col("group").alias("Category"), total.alias("Measure"), F.col("value").alias("Amount"), F.col("doc_id").cast("string").alias("Source_ID"),
        F.concat_ws(", ", F.lit("audited statement"), F.col("role")).alias("Source_Detail"), F.col("page_no").cast("int").alias("Source_Page"),
        F.lit("High").alias("Confidence"), F.col("extraction").alias("Extraction"), F.lit(True).alias("repeatable"),
        (F.col("page_no").cast("bigint") * 1000 + F.col("column_index")).alias("printed"))
    unknown = cells.filter(F.col("_route").isNull() & ~F.col("role").eqNullSafe(F.lit("variance")))
    kept = unknown.select(
        "Organization_ID", F.concat(F.lit("FY"), F.col("fiscal_year").cast("string")).alias("Fiscal_Year_ID"), F.col("statement").alias("Statement"),
        F.col("statement_key").alias("Statement_Key"), F.col("group").alias("Group"), F.col("line").alias("Line"), F.col("column_index").alias("Column_Index"),
        F.col("value").alias("Amount"), F.col("is_subtotal").alias("Is_Subtotal"), F.col("doc_id").cast("string").alias("Source_ID"),
        F.col("page_no").alias("Source_Page"), F.col("verified_by").alias("Verified_By"),
        confidence_ceiling(F.col("extraction"), F.lit("High")).alias("Confidence"), F.col("extraction").alias("Extraction"),
        F.lit("no total of this statement confirms which column is which").alias("basis_unknown_because"))
    return loads, typed(kept, schemas.FACT_STATEMENT_LINE)


def partition_digests(table: DataFrame, by: list[str]) -> DataFrame:
    """One row per partition: its row count and a digest of its content that does not depend on order."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])), 256)
    sums = [F.sum(F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(28,0)")).alias(f"_{i}") for i in range(4)]
    digest = F.sha2(F.concat_ws(":", "rows", *[F.col(f"_{i}").cast("string") for i in range(4)]), 256)
    return table.groupBy(*by).agg(F.count("*").alias("rows"), *sums).select(*by, "rows", F.substring(digest, 1, 16).alias("content"))


def publish(table: DataFrame, violations: list[DataFrame], path: str, ddl: str, by: list[str]) -> DataFrame:
    """Gate the build, write its new partitions and then the manifest; returns what was written: `by`, rows, content.

    Unchanged partitions are not written again, and partitions that are gone leave the manifest.
    """
    differs = gates.schema_frozen(table, ddl)
    if differs:
        raise gates.GateFailed("schema: " + "; ".join(differs))
    gates.gate(gates.real_violations(violations)) if violations else None
    spark = table.sparkSession
    current, version = _manifest(spark, path)
    held = partition_digests(table, by).persist()
    columns = [*by, "content"]
    fresh = held.join(current.select(*columns), columns, "left_anti") if current is not None else held
    gone = current.join(held.select(*columns), columns, "left_anti") if current is not None else held.limit(0)
    if not fresh.isEmpty():
        # Written by content, so nothing current is touched, and a failed try is simply overwritten.
        salted_join(table, fresh.select(*columns), by, "inner").hint("rebalance", *columns).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(f"{path}/data")
    if current is None or not (fresh.isEmpty() and gone.isEmpty()):
        held.write.mode("overwrite").parquet(f"{path}/manifest/v{version + 1:09d}")
    return fresh


def _manifest(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """The current manifest and its number: the last one that was written to its end."""
    jvm, context = spark._jvm, spark.sparkContext
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None, 0
    names = sorted(s.getPath().getName() for s in files.listStatus(folder))
    whole = [n for n in names if files.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{n}/_SUCCESS"))]
    if not whole:
        return None, int(names[-1][1:]) if names else 0
    return spark.read.parquet(f"{path}/manifest/{whole[-1]}"), int(names[-1][1:])


def published(spark: SparkSession, path: str, ddl: str, by: list[str]) -> DataFrame:
    """The current content of a published table."""
    current, _ = _manifest(spark, path)
    if current is None:
        raise FileNotFoundError(path)
    extra = "" if "content" in [f.name for f in StructType.fromDDL(ddl)] else ", content string"
    data = spark.read.schema(ddl + extra).parquet(f"{path}/data")
    return salted_join(data, current.select(*by, "content"), [*by, "content"], "left_semi").select(*[f"`{f.name}`" for f in StructType.fromDDL(ddl)])
