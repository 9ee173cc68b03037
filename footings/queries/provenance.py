"""The rows behind aggregates: sources, documents, pairs, mentions, missing figures, readings and trails."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.operators import provenance as ops
from footings.queries.registry import query
from footings.queries.sources import order_sheets


@query("a08_corroboration_sources", """
WITH v AS (SELECT l_partkey, l_quantity, l_suppkey, round(l_discount, 6) AS v FROM lineitem),
s AS (SELECT l_partkey, l_quantity, min(v) = max(v) AS one FROM v GROUP BY 1, 2)
SELECT l_partkey, l_quantity, CASE WHEN one THEN 'agreed' ELSE 'disputed' END AS role, l_suppkey AS source, v AS value, count(*) AS times FROM v JOIN s USING (l_partkey, l_quantity) GROUP BY ALL""")
def a08_sources(t):
    return ops.corroboration_sources(t.lineitem, ["l_partkey", "l_quantity"], "l_discount", "l_suppkey")


@query("a15_flow_documents", """
WITH l AS (SELECT year(l_shipdate) AS year, l_returnflag, l_linestatus, l_partkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_extendedprice END AS v FROM lineitem),
k AS (SELECT year, l_returnflag FROM l GROUP BY ALL HAVING sum(CAST(v AS DECIMAL(18,2))) <> 0)
SELECT CAST(year AS INTEGER) AS year, l_returnflag, l_linestatus, l_partkey, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS amount, min(l_linenumber) AS first_page, max(l_linenumber) AS last_page
FROM l JOIN k USING (year, l_returnflag) GROUP BY ALL""")
def a15_documents(t):
    """Each part is a document, its line numbers are pages."""
    lines = t.lineitem.withColumn("year", F.year("l_shipdate")).withColumn("v", F.when(F.col("l_partkey") % 5 == 0, 0.0).otherwise(F.col("l_extendedprice")))
    return ops.flow_documents(lines, ["year"], "l_returnflag", "l_linestatus", "v", "l_linenumber", "l_partkey")


@query("a35_name_pairs", """
SELECT p_name, p_brand, count(*) OVER (PARTITION BY p_name) AS containers FROM (SELECT DISTINCT p_name, p_brand FROM part)""")
def a35_pairs(t):
    return ops.name_pairs(t.part, "p_name", "p_brand")


@query("a36_sheet_mentions", """
WITH n AS (SELECT o_orderkey // 1000 AS sheet, count_if(o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1)
SELECT sheet, 'entity' AS role, 'urgent' AS value, CAST(urgent AS BIGINT) AS cells FROM n WHERE urgent > 0
UNION ALL SELECT sheet, 'year', CAST(y AS VARCHAR), 1 FROM n, (VALUES (2026), (2027)) v(y)""")
def a36_mentions(t):
    return ops.sheet_mentions(order_sheets(t), ["sheet"], {"urgent": "URGENT"})


@query("j09_missing_figures", """
WITH p AS (SELECT DISTINCT l_orderkey AS k, round_even(abs(l_extendedprice), 0) AS f FROM lineitem WHERE l_returnflag <> 'R'),
w AS (SELECT l_orderkey AS k, l_linenumber, l_partkey, unnest([l_extendedprice, l_quantity * l_linenumber, 0]) AS v FROM lineitem)
SELECT k AS orderkey, l_linenumber, l_partkey, v AS figure FROM w WHERE round_even(abs(v), 0) <> 0 AND k IN (SELECT k FROM p)
  AND NOT EXISTS (SELECT 1 FROM p WHERE p.k = w.k AND p.f = round_even(abs(w.v), 0))""")
def j09_missing(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey", F.array(
        F.col("l_extendedprice"), F.col("l_quantity") * F.col("l_linenumber"), F.lit(0.0)).alias("figures"))
    page = t.lineitem.filter("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("orderkey"), F.col("l_extendedprice").alias("figure"))
    return ops.missing_figures(rows, page, ["orderkey", "l_linenumber", "l_partkey"], ["orderkey"], "figures")


@query("j17_readings", """
WITH h AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders GROUP BY 1)
SELECT o_custkey, o_orderkey AS source, o_totalprice AS reading, round(h.v - o_totalprice, 2) AS gap FROM orders JOIN h USING (o_custkey)""")
def j17_readings(t):
    theirs = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("v"))
    return ops.readings_behind(theirs, t.orders.withColumn("v", F.col("o_totalprice")), ["o_custkey"], "v", "o_orderkey")


@query("w17_vintage_trail", """
WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderdate, o_orderkey, o_totalprice FROM orders),
f AS (SELECT o_custkey, year, arg_min(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)) AS v FROM o GROUP BY 1, 2)
SELECT o_custkey, year, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS recency, o_orderkey AS source, o_totalprice AS value, round(o_totalprice - v, 2) AS moved FROM o JOIN f USING (o_custkey, year)""")
def w17_trail(t):
    return ops.vintage_trail(t.orders.withColumn("year", F.year("o_orderdate")), ["o_custkey", "year"], F.to_date("o_orderdate").cast("string"), "o_totalprice", "o_orderkey")
