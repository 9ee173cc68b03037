"""Filters, vocabularies and statuses."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.functions.text import classify_first, flow_of
from footings.operators import filters as ops
from footings.queries.registry import query


@query("p01_facts_for", """
SELECT event_id, value FROM events WHERE event_type = 'purchase'
  AND (user_id % 10 = 0 OR day(ts) BETWEEN 5 AND 12)""")
def p01(t):
    """Users divisible by ten stand for facts without a year: a range keeps them."""
    events = t.events.withColumn("day", F.when(F.col("user_id") % 10 != 0, F.dayofmonth("ts")))
    return ops.facts_for(events, "purchase", 5, 12, "event_type", "day").select("event_id", "value")


@query("p02_slice", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 3""")
def p02(t):
    return ops.slice_of(t.lineitem, l_returnflag="R", l_linestatus="F", l_linenumber=3) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("p03_publishable", """
SELECT event_id, value FROM events WHERE event_type IN ('purchase', 'signup', 'view') AND value >= 5""")
def p03(t):
    facts = t.events.select("event_id", "event_type", F.when(F.col("value") >= 5, F.col("value")).alias("value"))
    return ops.publishable(facts, "value", "event_type", ["purchase", "signup", "view"]) \
        .select("event_id", "value")


PAGE_RULES = [(r"spam|pills", "messaging"), (r"^https?://blog\.", "media"), (r"/fr/|/es/|/de/", "translated"),
              (r"[?&]utm_", "campaign")]


@query("p04_classify_first", """
SELECT page_id, CASE WHEN regexp_matches(url, 'spam|pills') THEN 'messaging'
  WHEN url LIKE 'http://blog.%' OR url LIKE 'https://blog.%' THEN 'media'
  WHEN url LIKE '%/fr/%' OR url LIKE '%/es/%' OR url LIKE '%/de/%' THEN 'translated'
  WHEN url LIKE '%?utm_%' OR url LIKE '%&utm_%' THEN 'campaign' ELSE 'document' END AS category
FROM pages""")
def p04(t):
    return t.pages.select("page_id", classify_first(F.col("url"), PAGE_RULES, "document").alias("category"))


@query("p05_owner_of", """
SELECT c_custkey, coalesce(n_name, 'ORG_UNKNOWN') AS owner
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey""")
def p05(t):
    owners = t.nation.filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"),
                                                        F.col("n_name").alias("owner"))
    return ops.owner_of(t.customer.select("c_custkey", "c_nationkey"), owners, "c_nationkey", "owner") \
        .select("c_custkey", "owner")


@query("p06_text_layer", """
SELECT doc_id, CASE WHEN doc_id % 7 >= greatest(1, floor((doc_id % 9) * 0.6)) THEN 'scan'
  WHEN doc_id % 5 > 2 THEN 'digital' WHEN n_chars > 200 THEN 'digital' ELSE 'unknown' END AS layer
FROM documents""")
def p06(t):
    return t.documents.select("doc_id", ops.text_layer(
        F.col("doc_id") % 7, F.col("doc_id") % 9, F.greatest(F.col("doc_id") % 5 - 2, F.lit(0)),
        F.col("n_chars")).alias("layer"))


@query("p07_map_vocab", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Actual' WHEN 'O' THEN 'Estimate' ELSE '(violation)' END AS scenario
FROM orders""")
def p07(t):
    good, bad = ops.map_vocab(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus",
                              {"F": "Actual", "O": "Estimate"}, "scenario")
    return good.select("o_orderkey", "scenario").unionByName(
        bad.select("o_orderkey", F.lit("(violation)").alias("scenario")))


@query("p08_flow_of", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' THEN 'Revenue'
  WHEN o_orderstatus = 'O' THEN 'Expenditure' WHEN o_orderpriority = '2-HIGH' THEN 'Other Financing'
  ELSE '(unstated)' END AS flow FROM orders""")
def p08(t):
    group = F.when(F.col("o_orderstatus") == "F", "REVENUES").when(F.col("o_orderstatus") == "O", "Expenses")
    line = F.when(F.col("o_orderpriority") == "1-URGENT", "over Revenue") \
        .when(F.col("o_orderpriority") == "2-HIGH", "Financing uses").otherwise("Salaries")
    return t.orders.select("o_orderkey", flow_of(group, line).alias("flow"))


@query("p09_confidence_ceiling", """
WITH x AS (SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END AS cap,
  CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1
       WHEN '4-NOT SPECIFIED' THEN 0 ELSE 9 END AS claim FROM orders)
SELECT o_orderkey, CASE least(cap, claim) WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' WHEN 1 THEN 'Working' ELSE 'Pending' END AS confidence
FROM x""")
def p09(t):
    method = F.when(F.col("o_orderstatus") == "F", "digital-text").when(F.col("o_orderstatus") == "O", "derived") \
        .otherwise("something else")
    claim = ops.lookup(F.col("o_orderpriority"), {"1-URGENT": "High", "2-HIGH": "Medium",
                                                  "3-MEDIUM": "Working", "4-NOT SPECIFIED": "Pending"})
    return t.orders.select("o_orderkey", ops.confidence_ceiling(method, F.coalesce(claim, F.lit("?")))
                           .alias("confidence"))


@query("p10_authority_confidence", """
SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Working' WHEN c_acctbal < 0 THEN 'Pending' ELSE 'High' END AS source_confidence,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Working' WHEN c_custkey % 3 = 0 THEN 'Medium' ELSE 'High' END AS fact_confidence
FROM customer""")
def p10(t):
    authority = F.when(F.col("c_mktsegment") == "BUILDING", "government")
    layer = F.when(F.col("c_acctbal") < 0, "scan").otherwise("digital")
    method = F.when(F.col("c_custkey") % 3 == 0, "derived").otherwise("digital-text")
    return t.customer.select("c_custkey", ops.source_confidence(authority, layer).alias("source_confidence"),
                             ops.fact_confidence(authority, method).alias("fact_confidence"))


@query("p11_recurrence", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'Recurring' WHEN 'R' THEN 'One-Time' ELSE 'Unclassified' END AS recurrence
FROM lineitem""")
def p11(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", ops.recurrence(
        F.col("l_returnflag"), {"A": "Recurring", "R": "One-Time"}).alias("recurrence"))


@query("p12_coalesce_label", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'user' || CASE WHEN user_id % 2 = 0 THEN ' — even' ELSE '' END
  WHEN user_id % 2 = 0 THEN event_type || ' — even' ELSE event_type END AS label FROM events""")
def p12(t):
    first = F.when(F.col("event_type") != "error", F.col("event_type"))
    qualifier = F.when(F.col("user_id") % 2 == 0, "even").otherwise(F.coalesce(first, F.lit("user")))
    return t.events.select("event_id", ops.coalesce_label([first, F.lit("user")], qualifier).alias("label"))


@query("p13_canonical_source", """
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, 'DOC-' || min(o_orderkey) AS doc FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1 HAVING yr <> 1999),
r AS (SELECT o_orderkey, year(o_orderdate) AS yr,
             CASE WHEN o_custkey % 3 = 0 THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
                  WHEN o_custkey % 3 = 1 THEN 'REP_2001' ELSE '' END AS key,
             o_custkey IN (SELECT c_custkey FROM customer) AS known, o_custkey FROM orders)
SELECT o_orderkey, CASE WHEN key = '' THEN '' WHEN o_custkey % 3 = 0 AND known THEN key
          ELSE coalesce(y.doc, key) END AS source_id,
       CASE WHEN key <> '' AND NOT (o_custkey % 3 = 0 AND known) AND y.doc IS NOT NULL THEN 'register key ' || key END AS source_note
FROM r LEFT JOIN y ON y.yr = CASE WHEN o_custkey % 3 = 1 THEN 2001
   WHEN regexp_matches(key, '20\\d{2}') THEN CAST(regexp_extract(key, '(20\\d{2})', 1) AS INTEGER) ELSE r.yr END""")
def p13(t):
    kind = F.col("o_custkey") % 3
    refs = t.orders.select(
        "o_orderkey", F.year("o_orderdate").alias("year"),
        F.when(kind == 0, F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")))
        .when(kind == 1, "REP_2001").otherwise("").alias("src"))
    by_year = (t.orders.filter("o_orderstatus = 'F'").groupBy(F.year("o_orderdate").alias("year"))
               .agg(F.concat(F.lit("DOC-"), F.min("o_orderkey")).alias("document")).filter("year <> 1999"))
    documents = t.customer.select(F.col("c_name").alias("id"))
    return ops.canonical_source(refs, "src", "year", documents, by_year) \
        .select("o_orderkey", "source_id", "source_note")


@query("p14_coverage_status", """
WITH n AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal, count(o_orderkey) FILTER (o_orderstatus = 'F') AS n, count(o_orderkey) AS cited
           FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_custkey, CASE WHEN n > 3 THEN 'read' WHEN c_custkey % 11 = 0 THEN 'superseded-by-digital'
  WHEN c_acctbal < 0 AND c_custkey % 2 = 0 THEN 'scanned-unextractable' WHEN c_acctbal < 0 THEN 'no-figures'
  WHEN c_mktsegment = 'BUILDING' THEN 'design-document' WHEN c_mktsegment = 'MACHINERY' THEN 'no-figures'
  WHEN cited > 2 THEN 'read-into-datasets-only' ELSE 'not-yet-read' END AS status FROM n""")
def p14(t):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n"), F.count("*").alias("cited"))
    docs = t.customer.join(counts, "c_custkey", "left").na.fill(0, ["n", "cited"])
    status = ops.coverage_status(
        F.col("n") - 3, F.col("c_custkey") % 11 == 0, F.col("c_acctbal") >= 0, F.col("c_custkey") % 2 == 0,
        F.concat_ws("_", "c_mktsegment", "c_name"), ["building customer"], ["machinery customer"],
        F.col("cited") - 2)
    return docs.select("c_custkey", status.alias("status"))


@query("p15_retrieval_status", """
SELECT page_id, CASE WHEN url LIKE 'https://%' THEN 'url_recorded'
  WHEN NOT regexp_matches(url, '^http://blog') THEN 'authored_in_house'
  WHEN page_id % 2 = 0 THEN 'supplied_on_request' ELSE 'needs_official_url' END AS status FROM pages""")
def p15(t):
    url = F.col("url")
    return t.pages.select("page_id", ops.retrieval_status(
        F.when(url.startswith("https://"), url), F.when(url.startswith("http://blog"), "government"),
        F.concat(F.lit("File"), F.col("page_id"), F.when(F.col("page_id") % 2 == 0, ".XLSX").otherwise(".pdf")))
        .alias("status"))


@query("p16_two_boundaries", """
WITH s AS (SELECT year(o_orderdate) AS y, c_mktsegment AS g, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders JOIN customer ON o_custkey = c_custkey),
x AS (SELECT CAST(y AS INTEGER) AS year, CAST(sum(v) AS DOUBLE) AS total,
   CAST(sum(v) FILTER (g IN ('BUILDING','MACHINERY','FURNITURE')) AS DOUBLE) AS broad,
   CAST(sum(v) FILTER (g IN ('BUILDING','MACHINERY')) AS DOUBLE) AS narrow FROM s GROUP BY 1)
SELECT *, round(broad / total * 100, 1) AS broad_pct, round(narrow / total * 100, 1) AS narrow_pct FROM x""")
def p16(t):
    spend = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey") \
        .select(F.year("o_orderdate").alias("year"), "c_mktsegment", "o_totalprice")
    return ops.two_boundaries(spend, ["year"], "c_mktsegment", F.col("o_totalprice").cast("decimal(18,2)"),
                              ["BUILDING", "MACHINERY", "FURNITURE"], ["FURNITURE"])


@query("p17_export_view", """
SELECT 'ORG_' || o_custkey AS "Organization_ID", 'FY' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS "Fiscal_Year_ID",
       o_totalprice AS "Amount", CAST(o_orderkey AS VARCHAR) AS "Source_ID" FROM orders""")
def p17(t):
    from footings.functions.years import fy_short

    return ops.export_view(t.orders, {
        "Organization_ID": F.concat(F.lit("ORG_"), "o_custkey"), "Fiscal_Year_ID": fy_short(F.year("o_orderdate")),
        "Amount": "o_totalprice", "Source_ID": F.col("o_orderkey").cast("string")})


@query("p18_resolve_unique", """
WITH f AS (SELECT o_orderkey, 'file ' || o_orderkey AS filename, CASE WHEN o_orderkey % 50 = 0 THEN 2000 + o_orderkey % 97 + (o_custkey % 5) * 100 ELSE 1000 END AS yr FROM orders),
y AS (SELECT yr, count(*) AS n, min(filename) AS only_file FROM f GROUP BY 1 HAVING yr BETWEEN 2000 AND 2099),
r AS (SELECT c_custkey, c_custkey % 100 + 2000 AS yr, c_custkey % 4 = 0 AND c_custkey * 50 IN (SELECT o_orderkey FROM f) AS reg FROM customer)
SELECT c_custkey, CASE WHEN reg THEN 'registered' WHEN n = 1 THEN 'by year' WHEN n > 1 THEN 'ambiguous' ELSE 'unverifiable' END AS resolution,
  CASE WHEN reg THEN 'file ' || (c_custkey * 50) WHEN n = 1 THEN only_file END AS resolved_file
FROM r LEFT JOIN y USING (yr)""")
def p18(t):
    year = (F.col("o_orderkey") % 97 + (F.col("o_custkey") % 5) * 100 + 2000).cast("int")
    held = t.orders.select(F.concat(F.lit("file "), "o_orderkey").alias("filename"),
                           F.when(F.col("o_orderkey") % 50 == 0, year).otherwise(1000).alias("year"))
    source = F.concat(F.lit("REP_"), F.col("c_custkey") % 100 + 2000, F.lit("_"), F.col("c_custkey"))
    refs = t.customer.select("c_custkey", source.alias("src"))
    register = t.customer.select(
        F.when(F.col("c_custkey") % 4 == 0, source).otherwise(F.concat(F.lit("OTHER_"), "c_custkey")).alias("source_id"), F.concat(F.lit("file "), F.col("c_custkey") * 50).alias("filename"))
    return ops.resolve_unique(refs, "src", register, held).select("c_custkey", "resolution", "resolved_file")


@query("p19_verdict", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
  WHEN c_custkey % 2 = 0 THEN CASE WHEN c_acctbal >= floor_value THEN 'ok' ELSE 'bad' END
  ELSE CASE WHEN c_acctbal >= floor_value THEN 'watch' ELSE 'bad' END END AS verdict
FROM customer JOIN (SELECT c_mktsegment AS s, floor(avg(CAST(c_acctbal AS DECIMAL(18,2)))) AS floor_value FROM customer GROUP BY 1) ON s = c_mktsegment""")
def p19(t):
    floors = t.customer.groupBy("c_mktsegment").agg(
        F.when(F.col("c_mktsegment") != "FURNITURE", F.floor(F.avg(F.col("c_acctbal").cast("decimal(18,2)"))))
        .alias("floor_value"))
    return t.customer.join(floors, "c_mktsegment").select("c_custkey", ops.verdict(
        F.col("c_acctbal"), F.col("floor_value"), F.col("c_custkey") % 2 == 0).alias("verdict"))
