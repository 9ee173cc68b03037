"""The warehouse build over facts derived from the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings import schemas
from footings.plans import warehouse
from footings.queries.registry import query
from footings.session import scratch_folder, stored

BY = ["Organization_ID", "Fiscal_Year_ID"]


def no_text():
    return F.lit(None).cast("string")


def documents(t):
    """Documents of the archive, and the report of each year but 1996."""
    ids = t.customer.select(F.concat(F.lit("DOC-"), F.col("c_custkey") % 49).alias("id")).distinct()
    years = t.orders.select(F.year("o_orderdate").alias("year")).distinct()
    reports = years.filter("year <> 1996").select("year", F.concat(F.lit("REP-"), "year").alias("document"))
    return ids.unionByName(reports.select(F.col("document").alias("id"))), reports


def loads(t):
    """Line items print a grain as often as they like; an order is the only row of its grain, except where its account is shared."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    lines = t.lineitem.select(
        F.lit("ORG_HB").alias("Organization_ID"), F.year("l_shipdate").alias("Fiscal_Year"),
        F.when(F.col("l_returnflag") == "A", "Actual").when(F.col("l_returnflag") == "N", "Estimate").otherwise("Recommended").alias("Scenario"),
        F.concat(F.lit("FUND_"), "l_linenumber").alias("Fund_ID"), F.lit("Expenditure").alias("Flow"),
        F.concat(F.lit("S"), F.col("l_suppkey") % 10).alias("Department"), F.concat(F.lit("P"), F.col("l_partkey") % 100).alias("Account"),
        F.lit("appendix").alias("Category"), F.lit("amount").alias("Measure"), F.col("l_extendedprice").alias("Amount"),
        F.lit("DOC-1").alias("Source_ID"), F.lit("line-item appendix").alias("Source_Detail"), F.lit(1).alias("Source_Page"),
        F.lit("High").alias("Confidence"), F.lit("digital-text").alias("Extraction"), F.lit(True).alias("repeatable"),
        (F.col("l_orderkey") * 100_000_000 + cents).alias("printed"))
    k = F.col("o_orderkey")
    orders = t.orders.select(
        F.lit("ORG_OC").alias("Organization_ID"), F.year("o_orderdate").alias("Fiscal_Year"), F.lit("Adopted").alias("Scenario"),
        F.lit("FUND_GF").alias("Fund_ID"),
        F.when(F.col("o_orderstatus") == "F", "Revenue").when(F.col("o_orderstatus") == "O", "Expenditure").otherwise("Transfers").alias("Flow"),
        F.lit("(fund statement)").alias("Department"), F.when(k % 97 == 0, "shared").otherwise(F.concat(F.lit("O"), k)).alias("Account"),
        no_text().alias("Category"), F.lit("fund_total").alias("Measure"), F.when(k % 11 != 0, F.col("o_totalprice")).alias("Amount"),
        F.concat(F.lit("DOC-"), F.col("o_custkey") % 50).alias("Source_ID"), F.lit("statement").alias("Source_Detail"), F.lit(2).alias("Source_Page"),
        F.lit("High").alias("Confidence"), F.when(k % 4 == 0, "ocr-arithmetic-verified").otherwise("digital-text").alias("Extraction"),
        F.lit(False).alias("repeatable"), k.alias("printed"))
    return [lines, orders]


def digital(t):
    """Even years of the county are read directly."""
    years = t.orders.select(F.year("o_orderdate").alias("Fiscal_Year")).distinct().filter("Fiscal_Year % 2 = 0")
    return years.withColumn("Organization_ID", F.lit("ORG_OC"))


def build(t):
    return warehouse.financial_facts(loads(t), *documents(t), digital(t))


FACTS = """
docs AS (SELECT DISTINCT 'DOC-' || c_custkey % 49 AS id FROM customer UNION SELECT 'REP-' || year(o_orderdate) FROM orders WHERE year(o_orderdate) <> 1996),
l AS (SELECT 'ORG_HB' AS org, year(l_shipdate) AS fy, CASE l_returnflag WHEN 'A' THEN 'Actual' WHEN 'N' THEN 'Estimate' ELSE 'Recommended' END AS sc, 'FUND_' || l_linenumber AS fund,
  'Expenditure' AS flow, 'S' || l_suppkey % 10 AS dept, 'P' || l_partkey % 100 AS acc, 'amount' AS me, l_extendedprice AS amt, 'DOC-1' AS src, 'line-item appendix' AS det, 'High' AS conf, TRUE AS rep,
  l_orderkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS pr FROM lineitem),
o AS (SELECT 'ORG_OC' AS org, year(o_orderdate) AS fy, 'Adopted' AS sc, 'FUND_GF' AS fund, CASE o_orderstatus WHEN 'F' THEN 'Revenue' WHEN 'O' THEN 'Expenditure' ELSE 'Transfers' END AS flow,
  '(fund statement)' AS dept, CASE WHEN o_orderkey % 97 = 0 THEN 'shared' ELSE 'O' || o_orderkey END AS acc, 'fund_total' AS me, o_totalprice AS amt, 'DOC-' || o_custkey % 50 AS key,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Medium' ELSE 'High' END AS conf, o_orderkey AS pr FROM orders WHERE o_orderkey % 11 <> 0 AND NOT (o_orderkey % 4 = 0 AND year(o_orderdate) % 2 = 0)),
r AS (SELECT org, fy, sc, fund, flow, dept, acc, me, amt, CASE WHEN key IN (SELECT id FROM docs) OR fy = 1996 THEN key ELSE 'REP-' || fy END AS src,
  CASE WHEN key IN (SELECT id FROM docs) OR fy = 1996 THEN 'statement' ELSE 'statement; register key ' || key END AS det, conf, FALSE AS rep, pr FROM o),
a AS (SELECT * FROM l UNION ALL SELECT * FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY org, fy, sc, fund, flow, dept, acc, me ORDER BY pr) AS line FROM a WHERE flow <> 'Transfers'),
f AS (SELECT * FROM n WHERE rep OR line = 1)"""


@query("s08_warehouse_financial", f"""
WITH {FACTS}
SELECT org AS Organization_ID, 'FY' || fy AS Fiscal_Year_ID, sc AS Scenario, fund AS Fund_ID, flow AS Flow, dept AS Department, acc AS Account, me AS Measure, CAST(line AS INTEGER) AS Line,
  round(amt, 2) AS Amount, src AS Source_ID, det AS Source_Detail, conf AS Confidence FROM f""")
def s08_financial(t):
    """Both governments through one constructor: printed order, canonical sources, recognised years left out, capped confidence."""
    facts, _ = build(t)
    return facts.select(*schemas.GRAIN, "Line", "Amount", "Source_ID", "Source_Detail", "Confidence")


@query("s08_warehouse_violations", f"""
WITH {FACTS}
SELECT 'flow' AS gate, 'unknown flow Transfers' AS problem, count(*) AS n FROM a WHERE flow = 'Transfers' HAVING count(*) > 0
UNION ALL SELECT 'source', 'document not in the archive ' || src, count(*) FROM a WHERE src NOT IN (SELECT id FROM docs) GROUP BY src
UNION ALL SELECT 'grain', c || ' rows at one grain', count(*) FROM (SELECT count(*) AS c FROM n WHERE NOT rep GROUP BY org, fy, sc, fund, flow, dept, acc, me HAVING count(*) > 1) GROUP BY c""")
def s08_violations(t):
    _, problems = build(t)
    return problems.groupBy("gate", "problem").agg(F.count("*").alias("n"))


@query("s08_warehouse_publish", f"""
WITH {FACTS},
p AS (SELECT org, fy, count(*) AS rows FROM f GROUP BY ALL), last AS (SELECT max(fy) AS fy FROM p), low AS (SELECT min(fy) AS fy FROM p WHERE org = 'ORG_HB')
SELECT CAST(1 AS INTEGER) AS run, count(*) AS partitions, CAST(sum(rows) AS BIGINT) AS written, (SELECT count(*) FROM f) AS current FROM p
UNION ALL SELECT 2, 0, 0, (SELECT count(*) FROM f)
UNION ALL SELECT 3, count(*), CAST(coalesce(sum(rows), 0) AS BIGINT), (SELECT count(*) FROM f WHERE fy <> (SELECT fy FROM last)) FROM p WHERE org = 'ORG_HB' AND fy = (SELECT fy FROM low)""")
def s08_publish(t):
    """A second run writes nothing; a third writes the one year that was restated, and a year that is gone is no longer current."""
    path = scratch_folder(t.spark, "warehouse")
    # Every run reads the facts twice: they are built once.
    facts = stored(build(t)[0])
    year = F.substring("Fiscal_Year_ID", 3, 4).cast("int")
    ends = facts.agg(F.max(year).alias("last"), F.min(F.when(F.col("Organization_ID") == "ORG_HB", year)).alias("low")).first()
    restated = facts.filter(year != ends["last"]).withColumn("Amount", F.when(
        (F.col("Organization_ID") == "ORG_HB") & (year == ends["low"]), F.col("Amount") + 1).otherwise(F.col("Amount")))
    out = []
    for run, table in enumerate((facts, facts, restated), 1):
        fresh = warehouse.publish(table, [], path, schemas.FACT_FINANCIAL, BY)
        current = warehouse.published(t.spark, path, schemas.FACT_FINANCIAL, BY)
        done = fresh.agg(F.count("*").alias("partitions"), F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("written")).first()
        out.append((run, done["partitions"], done["written"], current.count()))
    return t.spark.createDataFrame(out, "run int, partitions bigint, written bigint, current bigint")


@query("s08_warehouse_metrics", """
SELECT 'ORG_OC' AS Organization_ID, 'FY' || CAST(2000 + p_size AS VARCHAR) AS Fiscal_Year_ID, CASE WHEN p_partkey % 3 = 0 THEN 'Net position — ' || p_brand ELSE 'Net position' END AS Metric,
  CASE WHEN p_partkey % 2 = 0 THEN 'Dollars' ELSE 'Dollars per pupil' END AS Unit, p_retailprice AS Amount, 'Working' AS Confidence FROM part WHERE p_partkey % 7 <> 0""")
def s08_metrics(t):
    """Metrics keep their unit and their qualifier; an import supports no more than working confidence."""
    k = F.col("p_partkey")
    rows = t.part.select(
        F.lit("ORG_OC").alias("Organization_ID"), (F.col("p_size") + 2000).alias("Fiscal_Year"), F.lit("Actual").alias("Scenario"), no_text().alias("Metric_ID"),
        F.lit("Net position").alias("Metric"), F.when(k % 3 == 0, F.col("p_brand")).alias("Qualifier"), F.when(k % 2 == 1, "Dollars per pupil").alias("Unit"),
        no_text().alias("Fund_ID"), no_text().alias("Fund"), no_text().alias("Activity_Type"), F.when(k % 7 != 0, F.col("p_retailprice")).alias("Amount"),
        F.concat(F.lit("DOC-"), k % 40).alias("Source_ID"), F.lit("workbook").alias("Source_Detail"), F.lit("3").alias("Source_Page"), F.lit("High").alias("Confidence"),
        F.lit("workbook-import").alias("Extraction"), no_text().alias("Notes"))
    facts, _ = warehouse.metric_facts(rows, *documents(t))
    return facts.select("Organization_ID", "Fiscal_Year_ID", "Metric", "Unit", "Amount", "Confidence")


def statement_cells(t):
    """Each line item as a figure of a statement; the return flag decides how well its column is known."""
    role = F.when(F.col("l_returnflag") == "A", "actual").when(F.col("l_returnflag") == "R", "prior_year_actual").when(F.col("l_linenumber") == 1, "variance")
    return t.lineitem.select(
        F.lit("ORG_HB").alias("Organization_ID"), F.year("l_shipdate").alias("fiscal_year"), F.lit("Statement").alias("statement"), F.lit("Exhibit 1").alias("statement_key"),
        F.lit("FUND_GF").alias("fund_id"), F.lit("Revenue").alias("flow"), F.lit("revenues").alias("group"), F.concat(F.lit("Line "), "l_partkey").alias("line"),
        F.col("l_linenumber").cast("int").alias("column_index"), F.col("l_extendedprice").alias("value"), role.alias("role"), (F.col("l_suppkey") % 10 == 0).alias("is_subtotal"),
        F.col("l_orderkey").alias("doc_id"), F.lit(4).alias("page_no"), F.lit("components sum").alias("verified_by"), F.lit("digital-text").alias("extraction"))


@query("s08_warehouse_statement_lines", """
SELECT 'line' AS kind, 'FY' || year(l_shipdate) AS year, NULL AS measure, 'Line ' || l_partkey AS line, l_extendedprice AS amount FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber <> 1
UNION ALL SELECT 'fact', 'FY' || CASE l_returnflag WHEN 'A' THEN year(l_shipdate) ELSE year(l_shipdate) - 1 END, CASE WHEN l_suppkey % 10 = 0 THEN 'fund_total' ELSE 'amount' END, 'Line ' || l_partkey, l_extendedprice
FROM lineitem WHERE l_returnflag <> 'N'""")
def s08_statement_lines(t):
    """A known role routes to scenario, measure and year; an unknown one stays in the statement table; a variance goes nowhere."""
    routed, kept = warehouse.routed_lines(statement_cells(t))
    facts = routed.select(F.lit("fact").alias("kind"), F.concat(F.lit("FY"), "Fiscal_Year").alias("year"), F.col("Measure").alias("measure"),
                          F.col("Account").alias("line"), F.col("Amount").alias("amount"))
    return kept.select(F.lit("line").alias("kind"), F.col("Fiscal_Year_ID").alias("year"), no_text().alias("measure"), F.col("Line").alias("line"),
                       F.col("Amount").alias("amount")).unionByName(facts)
