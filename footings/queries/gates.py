"""Gates return their violations; the build step that raises is tested separately."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.operators import gates as ops
from footings.queries.joins import RECONCILED, reconciliation
from footings.queries.registry import query


@query("g01_violations", """
SELECT 'customer' AS gate, CAST(c_custkey AS VARCHAR) AS "where", 'no owner' AS problem FROM customer WHERE c_nationkey = 7 AND c_mktsegment <> 'FURNITURE'
UNION ALL SELECT 'checks', CAST(s_suppkey AS VARCHAR), 'failed ' || CASE WHEN s_suppkey % 5 = 0 THEN 'agree' ELSE 'reconciles' END FROM supplier WHERE s_suppkey % 5 = 0 OR s_acctbal < 0""")
def g01(t):
    """INFO lines and listed conditions pass, and a check nobody could test passes too."""
    owners = ops.violation(t.customer.filter("c_nationkey = 7"), "customer", F.col("c_custkey"),
                           F.when(F.col("c_mktsegment") == "FURNITURE", "seg: INFO no owner needed").otherwise("no owner"))
    known = ops.violation(t.customer.filter("c_nationkey = 8"), "customer", F.col("c_custkey"), F.lit("known gap in 8"))
    checks = t.supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, False).when(F.col("s_suppkey") % 5 == 1, True).alias("agree"),
                               (F.col("s_acctbal") >= 0).alias("reconciles"))
    failed = ops.failed_checks(checks, F.col("s_suppkey"), ["agree", "reconciles"])
    return ops.real_violations([owners, known, failed], allowed=["known gap"])


@query("g02_fact_integrity", """
WITH e AS (SELECT event_id, event_type, user_id, CASE WHEN value >= 2 THEN value END AS v, event_id % 4 AS u FROM events)
SELECT 'facts' AS gate, CAST(event_id AS VARCHAR) AS "where", 'metric not registered' AS problem FROM e WHERE event_type = 'error'
UNION ALL SELECT 'facts', CAST(event_id AS VARCHAR), 'source not in the manifest' FROM e WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
UNION ALL SELECT 'facts', CAST(event_id AS VARCHAR), 'null value' FROM e WHERE v IS NULL
UNION ALL SELECT 'facts', CAST(event_id AS VARCHAR), 'extraction not trusted' FROM e WHERE u = 3
UNION ALL SELECT 'facts', CAST(event_id AS VARCHAR), 'unit differs from the registry' FROM e WHERE event_type <> 'error' AND event_type = 'view'""")
def g02(t):
    facts = t.events.select("event_id", F.col("event_type").alias("metric"), F.col("user_id").alias("source_doc"),
                            F.when(F.col("value") >= 2, F.col("value")).alias("value"), F.lit("USD").alias("unit"),
                            F.when(F.col("event_id") % 4 == 3, "ocr-unverified").otherwise("digital-text").alias("extraction"))
    documents = t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey")
    return ops.fact_integrity(facts, F.col("event_id"), {"view": "count", "click": "USD", "purchase": "USD", "signup": "USD"}, documents)


@query("g03_scan_figures", """
SELECT 'scan' AS gate, CAST(o_orderkey AS VARCHAR) AS "where", 'figure from a scanned text layer' AS problem
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0 AND o_orderstatus = 'F'""")
def g03(t):
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("doc"),
                            F.when(F.col("o_orderstatus") == "F", "digital-text").otherwise("transcribed").alias("extraction"))
    documents = t.customer.select(F.col("c_custkey").alias("doc"), F.when(F.col("c_acctbal") < 0, "scan").otherwise("digital").alias("text_layer"))
    return ops.scan_figures(facts, F.col("o_orderkey"), documents, "doc")


@query("g04_grain_unique", """
SELECT 'grain' AS gate, l_orderkey || '|' || l_linenumber AS "where", count(*) || ' rows at one grain' AS problem FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'owners', r, 'no rows loaded' FROM (VALUES ('X'), ('Y')) v(r)""")
def g04(t):
    return ops.grain_unique(t.lineitem, ["l_orderkey", "l_linenumber"]).unionByName(
        ops.owners_present(t.lineitem, "l_returnflag", ["A", "N", "R", "X", "Y"]))


@query("g05_single_source", """
SELECT 'source' AS gate, o_custkey || '|' || year(o_orderdate) AS "where", 'two documents: ' || min(o_orderpriority) || ', ' || max(o_orderpriority) AS problem
FROM orders GROUP BY o_custkey, year(o_orderdate) HAVING min(o_orderpriority) <> max(o_orderpriority)""")
def g05(t):
    return ops.single_source(t.orders.withColumn("year", F.year("o_orderdate")), ["o_custkey", "year"], "o_orderpriority")


@query("g06_confidence_kept", """
WITH x AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'Medium' ELSE 'Working' END AS c, CASE o_orderstatus WHEN 'F' THEN 'digital-text' WHEN 'O' THEN 'derived' ELSE 'workbook-import' END AS e FROM orders)
SELECT 'confidence' AS gate, CAST(o_orderkey AS VARCHAR) AS "where", c || ' from ' || e AS problem FROM x WHERE (e = 'derived' AND c = 'High') OR (e = 'workbook-import' AND c IN ('High', 'Medium'))""")
def g06(t):
    rows = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "High").when(F.col("o_orderpriority") == "2-HIGH", "Medium").otherwise("Working").alias("c"),
        F.when(F.col("o_orderstatus") == "F", "digital-text").when(F.col("o_orderstatus") == "O", "derived").otherwise("workbook-import").alias("e"))
    return ops.confidence_kept(rows, F.col("o_orderkey"), "c", "e")


def registered(t):
    """Documents named by source and language; one of each name is registered, plus one no longer held."""
    docs = t.documents.select(F.sha2(F.col("doc_id").cast("string"), 256).alias("sha"), F.concat_ws("-", "source", "lang").alias("slug"))
    first = docs.groupBy("slug").agg(F.min("sha").alias("sha"), F.max("sha").alias("last"))
    held = first.select("sha", F.col("slug").alias("id")).unionByName(
        first.filter("last <> sha").select(F.col("last").alias("sha"), F.concat("slug", F.lit("-3")).alias("id")))
    gone = first.filter("slug like 'src1-%'").select(F.sha2(F.concat(F.lit("gone"), "slug"), 256).alias("sha"),
                                                     F.concat("slug", F.lit("-6")).alias("id"))
    return docs, held.unionByName(gone)


@query("g07_assign_ids", """
WITH d AS (SELECT sha256(CAST(doc_id AS VARCHAR)) AS sha, source || '-' || lang AS slug FROM documents),
f AS (SELECT slug, min(sha) AS a, max(sha) AS b FROM d GROUP BY 1),
n AS (SELECT sha, slug, row_number() OVER (PARTITION BY slug ORDER BY sha) AS k FROM d WHERE sha NOT IN (SELECT a FROM f) AND sha NOT IN (SELECT b FROM f)),
s AS (SELECT sha, slug, CASE WHEN k = 1 THEN 2 WHEN slug LIKE 'src1-%' AND k >= 4 THEN k + 3 ELSE k + 2 END AS slot FROM n)
SELECT a AS sha, slug AS id, NULL AS problem FROM f UNION ALL SELECT b, slug || '-3', NULL FROM f WHERE a <> b
UNION ALL SELECT sha, slug || '-' || slot, NULL FROM s WHERE NOT (slug LIKE 'src1-%' AND slot > 6)
UNION ALL SELECT sha, NULL, 'ID COLLISION on ' || slug FROM s WHERE slug LIKE 'src1-%' AND slot > 6""")
def g07(t):
    named, bad = ops.assign_ids(*registered(t))
    return named.select("sha", "id", F.lit(None).cast("string").alias("problem")).unionByName(
        bad.select(F.col("where").alias("sha"), F.lit(None).cast("string").alias("id"), "problem"))


@query("g08_unexplained", f"""
WITH {RECONCILED} SELECT 'reconcile' AS gate, CAST(orderkey AS VARCHAR) AS "where", 'difference ' || printf('%.2f', -gap::DOUBLE) AS problem FROM c WHERE NOT ok AND NOT disclosed""")
def g08(t):
    return ops.unexplained(reconciliation(t), ["orderkey"])


@query("g09_stale_derived", """
SELECT 'stale' AS gate, CAST(d.doc_id AS VARCHAR) AS "where", CASE WHEN d.lang = 'de' THEN 'document is gone' ELSE 'content has changed' END AS problem
FROM documents d JOIN labels USING (doc_id) WHERE lang = 'de' OR (quality = 0 AND lang <> 'de')""")
def g09(t):
    """Labels remember the text they were made from; German texts went away, poor ones changed."""
    docs = t.documents.select("doc_id", "lang", F.sha2("text", 256).alias("sha"))
    derived = t.labels.join(docs, "doc_id").select("doc_id", F.when(F.col("quality") == 0, F.sha2(F.concat("sha", F.lit("-")), 256))
                                                  .otherwise(F.col("sha")).alias("sha"))
    return ops.stale_derived(derived, docs.filter("lang <> 'de'"), "doc_id", "sha")[1]
