"""Aggregations, shares, matrices and proofs."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.operators import aggregates as ops
from footings.operators import proof
from footings.queries.registry import query


def dec(c):
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


@query("a01_sum_by", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY ALL""")
def a01(t):
    return ops.sum_by(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")


COMPARE = """
c AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS readings, min(o_totalprice) AS lowest, max(o_totalprice) AS highest
      FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2 HAVING count(*) >= 2)"""


def comparisons(t):
    facts = t.orders.withColumn("year", F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")))
    return facts, ops.compare_sources(facts, ["o_custkey", "year"], "o_totalprice")


@query("a02_compare_sources", f"""
WITH {COMPARE} SELECT *, round(highest - lowest, 2) AS spread, round((highest - lowest) / abs(lowest) * 100, 1) AS spread_pct_of_min FROM c""")
def a02(t):
    return comparisons(t)[1]


@query("a02_readings", f"""
WITH {COMPARE} SELECT o_orderkey, o_totalprice FROM orders JOIN c ON c.o_custkey = orders.o_custkey AND c.year = year(o_orderdate) WHERE o_orderstatus <> 'P'""")
def a02_readings(t):
    facts, found = comparisons(t)
    return ops.readings_of(facts, found, ["o_custkey", "year"]).select("o_orderkey", "o_totalprice")


@query("a04_contributions", """
SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers,
  (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers,
  (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) + (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS facts_total FROM nation""")
def a04(t):
    return ops.contributions({"customers": (t.customer, "c_nationkey"), "suppliers": (t.supplier, "s_nationkey")},
                             t.nation, "n_nationkey")


@query("a05_coverage_matrix", """
WITH c AS (SELECT o_custkey AS k, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2),
g AS (SELECT k, y FROM (SELECT DISTINCT k FROM c), (SELECT DISTINCT y FROM c))
SELECT g.k AS o_custkey, CAST(g.y AS INTEGER) AS year, coalesce(n, 0) AS facts, CASE WHEN n IS NULL THEN 'empty' WHEN n < 2 THEN 'thin' ELSE 'covered' END AS state
FROM g LEFT JOIN c ON c.k = g.k AND c.y = g.y""")
def a05(t):
    facts = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"))
    return ops.coverage_matrix(facts, "o_custkey", "year", 2)


@query("a06_summary", """
SELECT o_orderpriority, count(*) AS orders, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS finished,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS open_amount, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1""")
def a06(t):
    return ops.summary(t.orders, ["o_orderpriority"], {
        "orders": F.count("*"), "finished": F.count_if(F.col("o_orderstatus") == "F"),
        "open_amount": ops.total(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))),
        "customers": F.countDistinct("o_custkey")})


@query("a07_cited_documents", """
WITH c AS (SELECT 'returned' AS s, l_partkey AS d FROM lineitem WHERE l_returnflag = 'R' UNION SELECT 'accepted', l_partkey FROM lineitem WHERE l_returnflag = 'A'
  UNION SELECT 'open', l_partkey FROM lineitem WHERE l_returnflag = 'N'
  UNION SELECT 'catalogue', p_partkey FROM part)
SELECT d AS document, count(*) AS datasets FROM c GROUP BY 1""")
def a07(t):
    return ops.evidence_base(ops.cited_documents({
        "returned": (t.lineitem.filter("l_returnflag = 'R'"), "l_partkey"),
        "accepted": (t.lineitem.filter("l_returnflag = 'A'"), "l_partkey"),
        "open": (t.lineitem.filter("l_returnflag = 'N'"), "l_partkey"), "catalogue": (t.part, "p_partkey")}))


@query("a08_corroborate", """
WITH v AS (SELECT l_partkey AS p, l_quantity AS q, round(l_discount, 6) AS v, count(*) AS n, min(l_suppkey) AS f FROM lineitem GROUP BY 1, 2, 3)
SELECT p AS l_partkey, q AS l_quantity, CASE WHEN count(*) = 1 THEN min(v) END AS value, count(*) AS distinct_values, CAST(sum(n) AS BIGINT) AS editions,
  min(f) AS first_edition, CASE WHEN count(*) = 1 THEN 'agreed' ELSE 'disputed' END AS state FROM v GROUP BY 1, 2""")
def a08(t):
    return ops.corroborate(t.lineitem, ["l_partkey", "l_quantity"], "l_discount", "l_suppkey")


def classified(t):
    """Parts are line prices, a third of them blank; the stated total is sometimes off."""
    parts = t.lineitem.select(F.col("l_orderkey").alias("orderkey"),
                              F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice")).otherwise(0.0).alias("part"))
    sums = parts.groupBy("orderkey").agg(F.sum(dec("part")).cast("double").alias("s"))
    stated = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus", "o_custkey").join(sums, "orderkey", "left") \
        .withColumn("stated", F.when(F.col("o_custkey") % 3 == 0, F.col("s") + 0.5).when(F.col("o_custkey") % 3 == 1, F.col("s") - 2))
    return parts, stated, ops.classify_total(parts, stated, ["orderkey"], "part", "stated")


CLASSIFIED = """
p AS (SELECT l_orderkey AS k, CAST(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS DECIMAL(18,2)) AS v FROM lineitem),
s AS (SELECT k, CAST(coalesce(sum(v), 0) AS DOUBLE) AS s, count(v) AS n FROM p GROUP BY 1),
c AS (SELECT o_orderkey AS orderkey, o_orderstatus, CASE WHEN o_custkey % 3 = 0 THEN s + 0.5 WHEN o_custkey % 3 = 1 THEN s - 2 END AS stated_total,
        coalesce(s, 0) AS parts_sum, coalesce(n, 0) AS parts, o_custkey % 3 AS m FROM orders LEFT JOIN s ON k = o_orderkey),
d AS (SELECT *, round(parts_sum - stated_total, 2) AS variance, coalesce(abs(round(parts_sum - stated_total, 2)) <= 1, FALSE) AS reconciles FROM c),
e AS (SELECT *, CASE WHEN reconciles THEN 'reconciles' WHEN parts < 5 THEN 'components incomplete' ELSE 'presentation difference' END AS state FROM d)"""


@query("a10_classify_total", f"WITH {CLASSIFIED} SELECT orderkey, stated_total, parts_sum, parts, variance, reconciles, state FROM e")
def a10(t):
    return classified(t)[2]


@query("a11_variance_by", f"""
WITH {CLASSIFIED} SELECT o_orderstatus, count(*) AS totals, CAST(count_if(reconciles) AS BIGINT) AS reconcile, CAST(count_if(state = 'components incomplete') AS BIGINT) AS incomplete,
  CAST(count_if(state = 'presentation difference') AS BIGINT) AS differ, min(variance) FILTER (state <> 'components incomplete') AS variance_low,
  max(variance) FILTER (state <> 'components incomplete') AS variance_high FROM e GROUP BY 1""")
def a11(t):
    _, stated, found = classified(t)
    return ops.variance_by(found.join(stated.select("orderkey", "o_orderstatus"), "orderkey"), ["o_orderstatus"])


@query("a12_shares", """
WITH x AS (SELECT c_mktsegment, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS v FROM customer),
g AS (SELECT c_mktsegment, c_nationkey, CAST(sum(v) AS DOUBLE) AS amount FROM x GROUP BY 1, 2),
w AS (SELECT c_mktsegment, CAST(sum(v) AS DOUBLE) AS whole FROM x GROUP BY 1)
SELECT g.*, CASE WHEN c_mktsegment <> 'BUILDING' THEN round(amount / whole * 100, 2) END AS share_pct FROM g JOIN w USING (c_mktsegment)""")
def a12(t):
    gate = t.customer.select("c_mktsegment", (F.col("c_mktsegment") != "BUILDING").alias("reconciles")).distinct()
    return ops.shares(t.customer, ["c_mktsegment"], "c_nationkey", "c_acctbal", gate)


@query("a13_fund_shares", """
WITH x AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
g AS (SELECT year, o_orderstatus, CAST(sum(v) AS DOUBLE) AS amount FROM x GROUP BY 1, 2),
w AS (SELECT year, CAST(sum(v) AS DOUBLE) AS whole, CAST(sum(v) AS DOUBLE) + CASE WHEN year % 2 = 0 THEN 0.5 ELSE 500 END AS stated FROM x GROUP BY 1)
SELECT year, o_orderstatus, amount, year % 2 = 0 AS agrees, round(amount / whole * 100, 4) AS width_pct,
  round(amount / CASE WHEN year % 2 = 0 THEN stated ELSE whole END * 100, 4) AS share_pct, CASE WHEN year % 2 = 0 THEN 'of the total' ELSE 'of the parts' END AS label
FROM g JOIN w USING (year)""")
def a13(t):
    parts = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice")
    stated = ops.sum_by(parts, ["year"], "o_totalprice", "s").select(
        "year", (F.col("s") + F.when(F.col("year") % 2 == 0, 0.5).otherwise(500.0)).alias("stated"))
    return ops.fund_shares(parts, ["year"], "o_orderstatus", "o_totalprice", stated, "stated")


@query("a14_drill", """
WITH i AS (SELECT p_brand, p_type, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS detail_total FROM part GROUP BY 1, 2),
o AS (SELECT p_brand, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS group_total FROM part GROUP BY 1)
SELECT * FROM i JOIN o USING (p_brand)""")
def a14(t):
    return ops.drill(t.part, "p_brand", "p_type", "p_retailprice")


MATRIX = """
x AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS src, l_linestatus AS dst, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, l_linenumber AS page, l_suppkey AS doc FROM lineitem),
m AS (SELECT year, src, CAST(coalesce(sum(v) FILTER (dst = 'F'), 0) AS DOUBLE) AS F, CAST(coalesce(sum(v) FILTER (dst = 'O'), 0) AS DOUBLE) AS O, CAST(sum(v) AS DOUBLE) AS total_out,
        count(DISTINCT doc) AS source_docs, min(page) AS first_page, max(page) AS last_page FROM x GROUP BY 1, 2)"""


def matrix(t):
    flows = t.lineitem.select(F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("src"),
                              F.col("l_linestatus").alias("dst"), "l_extendedprice", "l_linenumber", "l_suppkey")
    return ops.flow_matrix(flows, ["year"], "src", "dst", "l_extendedprice", ["F", "O"], "l_linenumber", "l_suppkey")


@query("a15_flow_matrix", f"WITH {MATRIX} SELECT * FROM m")
def a15(t):
    return matrix(t)


@query("a15_flow_received", f"""
WITH {MATRIX} SELECT year, CAST(sum(CAST(F AS DECIMAL(18,2))) AS DOUBLE) AS F, CAST(sum(CAST(O AS DECIMAL(18,2))) AS DOUBLE) AS O, CAST(sum(CAST(total_out AS DECIMAL(18,2))) AS DOUBLE) AS total_transferred FROM m GROUP BY 1""")
def a15_received(t):
    return ops.flow_received(matrix(t), ["year"], ["F", "O"])


@query("a16_recurrence_split", """
WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'A') AS DOUBLE) AS recurring,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R') AS DOUBLE) AS one_time, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'N') AS DOUBLE) AS unclassified FROM lineitem GROUP BY 1)
SELECT *, round(recurring / (recurring + one_time + unclassified) * 100, 1) AS recurring_pct_of_all, round(recurring / (recurring + one_time) * 100, 1) AS recurring_pct_of_classified FROM s""")
def a16(t):
    return ops.recurrence_split(t.lineitem.withColumn("year", F.year("l_shipdate")), ["year"], "l_returnflag",
                                "l_extendedprice", {"A": "Recurring", "R": "One-Time"})


@query("a17_dimension_coverage", """
SELECT 'user' AS dimension, count(user_id) AS filled, count(*) AS rows, 'fully filled' AS status FROM events
UNION ALL SELECT 'priced', count(*) FILTER (value > 50), count(*), 'partly filled' FROM events
UNION ALL SELECT 'fund', 0, count(*), 'not fillable' FROM events""")
def a17(t):
    return ops.dimension_coverage(t.events, {
        "user": F.col("user_id"), "priced": F.when(F.col("value") > 50, F.col("value")),
        "fund": F.get_json_object("props", "$.fund")})


@query("a18_rollup_projects", """
SELECT coalesce(CASE WHEN s_nationkey % 6 <> 0 THEN 'FUND_' || s_nationkey END, 'Unstated') AS fund, count(*) AS projects,
  CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_planned_cost, CAST(count_if(s_acctbal > 5000) AS BIGINT) AS create_recurring_cost FROM supplier GROUP BY 1""")
def a18(t):
    projects = t.supplier.withColumn("fund", F.when(F.col("s_nationkey") % 6 != 0, F.concat(F.lit("FUND_"), "s_nationkey")))
    return ops.rollup_projects(projects, "fund", "s_acctbal", F.col("s_acctbal") > 5000)


def order_columns(t):
    """Three columns per order; the printed third column is off for some customers, blank for others."""
    members = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), F.array(
        F.col("l_extendedprice"), F.col("l_quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_tax"))).alias("values"))
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.sum(dec("l_extendedprice")).cast("double").alias("a"), F.sum(dec("l_quantity")).cast("double").alias("b"),
        F.sum(dec(F.when(F.col("l_returnflag") != "R", F.col("l_tax")))).cast("double").alias("c"))
    who = t.orders.select(F.col("o_orderkey").alias("orderkey"), (F.col("o_custkey") % 4).alias("m"))
    totals = sums.join(who, "orderkey").select("orderkey", F.array(
        "a", F.when(F.col("m") != 3, F.col("b")), F.when(F.col("m") == 1, F.col("c") + 0.01).otherwise(F.col("c"))).alias("values"))
    return members, totals


COLUMNS = """
s AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS a, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS b,
        CAST(sum(CAST(l_tax AS DECIMAL(18,2))) FILTER (l_returnflag <> 'R') AS DOUBLE) AS c, count(*) AS n, count(*) FILTER (l_returnflag <> 'R') AS nc, o_custkey % 4 AS m
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, o_custkey),
q AS (SELECT k AS orderkey, CAST(0 AS INTEGER) AS column_index, a AS printed_total, a AS sum_of_lines, n AS lines, 0::DOUBLE AS variance, TRUE AS reconciles FROM s
  UNION ALL SELECT k, 1, CASE WHEN m <> 3 THEN b END, b, n, CASE WHEN m <> 3 THEN 0 END, CASE WHEN m <> 3 THEN TRUE END FROM s
  UNION ALL SELECT k, 2, CASE WHEN m = 1 THEN c + 0.01 ELSE c END, c, nc, CASE WHEN c IS NOT NULL THEN CASE WHEN m = 1 THEN -0.01 ELSE 0 END END, CASE WHEN c IS NOT NULL THEN m <> 1 END FROM s)"""


@query("a19_prove_columns", f"WITH {COLUMNS} SELECT * FROM q")
def a19(t):
    return proof.prove_columns(*order_columns(t), ["orderkey"])


@query("a19_prove_groups", f"""
WITH {COLUMNS} SELECT orderkey, count(reconciles) AS columns_checked, coalesce(bool_and(reconciles), FALSE) AS proven FROM q GROUP BY 1""")
def a19_groups(t):
    return proof.prove_groups(proof.prove_columns(*order_columns(t), ["orderkey"]), ["orderkey"])


@query("a20_prove_offset", """
WITH s AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS a, count(*) AS n, o_custkey % 4 AS m FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, o_custkey)
SELECT k AS orderkey, CAST(0 AS INTEGER) AS members_column, CAST(1 AS INTEGER) AS total_column, a AS sum_of_lines, a + 1 AS printed_total FROM s WHERE n >= 2 AND m = 2""")
def a20(t):
    members = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), F.array(
        F.col("l_extendedprice"), F.lit(None).cast("double")).alias("values"))
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.sum(dec("l_extendedprice")).cast("double").alias("a"))
    who = t.orders.select(F.col("o_orderkey").alias("orderkey"), (F.col("o_custkey") % 4).alias("m"))
    totals = sums.join(who, "orderkey").select("orderkey", F.array(
        F.when(F.col("m") == 1, F.col("a")), F.col("a") + F.when(F.col("m") == 2, 1).otherwise(2)).alias("values"))
    return proof.prove_offset(proof.prove_columns(members, totals, ["orderkey"]), ["orderkey"])


@query("a21_infer_roles", """
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT o_custkey, CAST(4 AS INTEGER) AS columns, CASE WHEN n < 3 OR o_custkey % 4 = 3 THEN NULL WHEN o_custkey % 4 = 0 THEN 'variance after three columns'
  WHEN o_custkey % 4 = 1 THEN 'variance after two columns' ELSE 'capital project schedule' END AS layout,
  CASE WHEN n < 3 OR o_custkey % 4 = 3 THEN NULL WHEN o_custkey % 4 = 0 THEN 'actual' WHEN o_custkey % 4 = 1 THEN 'variance' ELSE 'current_year_actual' END AS third_role FROM c""")
def a21(t):
    v, m = F.col("o_totalprice"), F.col("o_custkey") % 4
    values = (F.when(m == 0, F.array(v * 3, v, v * 1.5 + 7, v * 0.5 + 7)).when(m == 1, F.array(v, v * 2 + 40, v + 40, v * 9))
              .when(m == 2, F.array(v * 5, v + 60, v * 2, v * 3 + 60)).otherwise(F.array(v, v * 4, v * 16 + 5, v * 64)))
    roles = proof.infer_roles(t.orders.select("o_custkey", values.alias("values")), ["o_custkey"])
    return roles.select("o_custkey", "columns", "layout", F.col("column_roles")["2"].alias("third_role"))


@query("a22_prove_rollforward", """
WITH o AS (SELECT o_orderkey AS k, o_totalprice AS v, o_custkey::DOUBLE AS c, o_custkey % 3 AS m FROM orders)
SELECT k AS orderkey, CAST(0 AS INTEGER) AS column_index, 'Revenues over expenditures' AS line, v - c AS value FROM o
UNION ALL SELECT k, 1, 'Revenues over expenditures', v * 2 - c + CASE WHEN m = 1 THEN 1 ELSE 0 END FROM o WHERE m <> 2
UNION ALL SELECT k, 0, 'Fund balance, ending', v + 100 FROM o WHERE m <> 1
UNION ALL SELECT k, 0, 'Fund balance, beginning', v FROM o WHERE m <> 1""")
def a22(t):
    v, c, m = F.col("o_totalprice"), F.col("o_custkey").cast("double"), F.col("o_custkey") % 3
    none = F.lit(None).cast("double")
    lines = [("Total revenues", v, v * 2), ("Total expenditures", c, c),
             ("Revenues over expenditures", v - c, v * 2 - c + F.when(m == 1, 1).when(m == 2, 9).otherwise(0)),
             ("Net change in fund balance", F.lit(100.0), none), ("Fund balance, beginning", v, v),
             ("Fund balance, ending", v + F.when(m == 1, 300).otherwise(100), none)]
    rows = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.posexplode(F.array(*[
        F.struct(F.lit(n).alias("label"), F.array(a.cast("double"), b.cast("double")).alias("values")) for n, a, b in lines]))
        .alias("ordinal", "r")).select("orderkey", "ordinal", "r.label", "r.values")
    out = proof.prove_rollforward(rows, ["orderkey"], "ordinal", "label", "values")
    return out.select("orderkey", "column_index", "line", "value")


WORDS = r"""
w AS (SELECT conv_id, role, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM conversations),
u AS (SELECT conv_id, word, count(*) AS n FROM w WHERE role = 'user' GROUP BY 1, 2),
a AS (SELECT conv_id, word, count(*) AS n FROM w WHERE role = 'assistant' GROUP BY 1, 2),
b AS (SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.n, 0) AS t, coalesce(a.n, 0) AS g FROM u FULL JOIN a ON u.conv_id = a.conv_id AND u.word = a.word)"""
SUMS = """CAST(sum(t) AS BIGINT) AS truth, CAST(sum(g) AS BIGINT) AS got, CAST(sum(least(t, g)) AS BIGINT) AS matched, CAST(sum(greatest(t - g, 0)) AS BIGINT) AS missed, CAST(sum(greatest(g - t, 0)) AS BIGINT) AS spurious"""
RATES = """CASE WHEN truth = 0 THEN 0::DOUBLE ELSE round(matched * 100.0::DOUBLE / truth, 1) END AS recall_pct, CASE WHEN got = 0 THEN 0::DOUBLE ELSE round(matched * 100.0::DOUBLE / got, 1) END AS precision_pct"""


def word_match(t):
    words = t.conversations.select("conv_id", "role", F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return ops.multiset_match(words.filter("role = 'user'"), words.filter("role = 'assistant'"), ["conv_id"], "word")


@query("a23_multiset_match", f"WITH {WORDS}, s AS (SELECT conv_id, {SUMS} FROM b GROUP BY 1) SELECT *, {RATES} FROM s")
def a23(t):
    return word_match(t)


@query("a23_overall_match", f"WITH {WORDS}, s AS (SELECT {SUMS} FROM b) SELECT *, {RATES} FROM s")
def a23_overall(t):
    return ops.overall_match(word_match(t))


@query("a24_dedupe_by_hash", """
WITH n AS (SELECT sha256(text) AS sha, source || CASE WHEN doc_id % 3 = 0 THEN ' (1) ' ELSE ' ' END || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS name, doc_id % 3 = 0 AS artefact FROM documents),
c AS (SELECT sha, arg_min(name, (artefact, name)) AS canonical, count(*) AS copies FROM n GROUP BY 1)
SELECT n.sha, canonical, name AS duplicate, copies FROM n JOIN c USING (sha) WHERE name <> canonical
UNION ALL SELECT sha, canonical, NULL, copies FROM c""")
def a24(t):
    named = t.documents.select(F.sha2("text", 256).alias("sha"), F.concat(
        "source", F.when(F.col("doc_id") % 3 == 0, " (1) ").otherwise(" "), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("name"))
    canonical, copies = ops.dedupe_by_hash(named, "sha", "name", [])
    heads = canonical.select("sha", F.col("name").alias("canonical"), "copies")
    return copies.join(heads.select("sha", "copies"), "sha").unionByName(
        heads.withColumn("duplicate", F.lit(None).cast("string")))


@query("a25_choose_best", """
WITH b AS (SELECT s_nationkey, arg_min(s_suppkey, (-s_acctbal, s_suppkey)) AS best, max(s_acctbal) AS top FROM supplier GROUP BY 1)
SELECT s.s_nationkey, s_suppkey, s_acctbal, s_suppkey = best AS chosen, CASE WHEN s_suppkey <> best THEN best END AS chosen_instead, CASE WHEN s_suppkey <> best THEN top END AS chosen_s_acctbal
FROM supplier s JOIN b ON b.s_nationkey = s.s_nationkey""")
def a25(t):
    return ops.choose_best(t.supplier, "s_nationkey", "s_suppkey", [-F.col("s_acctbal"), F.col("s_suppkey")], "s_acctbal")


@query("a26_burden", """
WITH p AS (SELECT split_part(url, '/', 3) AS host, lpad(CAST(page_id AS VARCHAR), 9, '0') AS name, CASE WHEN page_id % 5 <> 0 THEN length(html) END AS pages FROM pages),
r AS (SELECT host, name, row_number() OVER (PARTITION BY host ORDER BY name) AS rn FROM p)
SELECT host, count(*) AS documents, CAST(sum(coalesce(pages, 0)) AS BIGINT) AS pages, (SELECT string_agg(name, ' | ' ORDER BY name) FROM r WHERE r.host = p.host AND rn <= 3) AS examples FROM p GROUP BY host""")
def a26(t):
    docs = t.pages.select(F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
                          F.lpad(F.col("page_id").cast("string"), 9, "0").alias("name"),
                          F.when(F.col("page_id") % 5 != 0, F.length("html")).alias("pages"))
    return ops.burden(docs, "host", "name", "pages")


@query("a27_status_counts", """
SELECT o_orderpriority, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS F, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS O, CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS P FROM orders GROUP BY 1""")
def a27(t):
    return ops.status_counts(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("a28_estimate_skew", """
WITH w AS (SELECT user_id, CAST(day(ts) AS INTEGER) % 3 AS page, floor(value) + 5 AS x, minute(ts) * 2.0::DOUBLE + 2 AS y FROM events),
h AS (SELECT user_id, page, i, round_even(y - i / 2000.0::DOUBLE * x, 0) AS line, count(*) AS n FROM w, range(-60, 61) r(i) GROUP BY ALL),
s AS (SELECT user_id, page, i, sum(n * n) AS score, sum(n) AS words FROM h GROUP BY ALL)
SELECT user_id, page, CASE WHEN max(words) >= 12 THEN arg_max(i, (score, -i)) / 2000.0::DOUBLE ELSE 0 END AS slope FROM s GROUP BY ALL""")
def a28(t):
    words = t.events.select("user_id", (F.dayofmonth("ts") % 3).alias("page"), F.floor("value").alias("x0"),
                            (F.floor("value") + 10).alias("x1"), (F.minute("ts") * 2.0).alias("top"), (F.minute("ts") * 2.0 + 4).alias("bottom"))
    return ops.estimate_skew(words, ["user_id", "page"])


@query("a29_impact_by_kind", """
WITH x AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'debt service' WHEN 'R' THEN CASE WHEN l_linestatus = 'F' THEN 'maintenance and utilities' ELSE 'transfer to a capital fund' END ELSE 'further capital spending' END AS kind,
  CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem)
SELECT l_orderkey, kind, CAST(sum(v) AS DOUBLE) AS amount, kind IN ('debt service', 'maintenance and utilities') AS recurring FROM x GROUP BY 1, 2""")
def a29(t):
    account = (F.when(F.col("l_returnflag") == "A", "Debt service - bonds")
               .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "Insurance and operating transfer")
               .when(F.col("l_returnflag") == "R", "Transfer to fund 60").otherwise("Buildings"))
    rows = t.lineitem.select("l_orderkey", account.alias("account"), F.array("l_extendedprice", "l_quantity", F.lit(None).cast("double")).alias("amounts"))
    return ops.impact_by_kind(rows, "l_orderkey", "account", "amounts")


@query("a30_split_plan", """
WITH x AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS a, list_sum([CAST(CAST(v AS DOUBLE) * 100 AS DECIMAL(18,2)) for v in embedding[2:]]) AS r, len(embedding) AS n FROM embeddings),
s AS (SELECT label, CAST(sum(CAST(a * 100 AS DECIMAL(18,2))) AS DOUBLE) AS already, CAST(sum(r) AS DOUBLE) AS plan_window FROM x GROUP BY 1)
SELECT label, already, plan_window, TRUE AS shape_ok, label % 2 = 0 AS reconciles FROM s""")
def a30(t):
    amounts = F.transform("embedding", lambda v: v.cast("double") * 100)
    plans = t.embeddings.select("label", amounts.alias("amounts"))
    sums = plans.select("label", F.explode("amounts").alias("v")).groupBy("label").agg(F.sum(dec("v")).cast("double").alias("s"))
    stated = sums.select("label", (F.col("s") + F.when(F.col("label") % 2 == 0, 0.5).otherwise(3.0)).alias("stated"))
    return ops.split_plan(plans, ["label"], "amounts", stated, "stated", 64)


@query("a31_melt", """
SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'price', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', l_discount FROM lineitem WHERE l_discount > 0""")
def a31(t):
    wide = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("quantity"),
                             F.col("l_extendedprice").alias("price"), F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount"))
    return ops.melt(wide, ["l_orderkey", "l_linenumber", "l_partkey"], ["quantity", "price", "discount"])


@query("a32_dim_year", """
SELECT 'FY' || year(o_orderdate) AS fiscal_year, (year(o_orderdate) - 1) || '-07-01' AS starts, year(o_orderdate) || '-06-30' AS ends,
  string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS scenarios, count(*) AS facts FROM orders GROUP BY year(o_orderdate)""")
def a32(t):
    from footings.functions.years import fy_id

    return ops.dim_year(t.orders.withColumn("fiscal_year", fy_id(F.year("o_orderdate"))), "fiscal_year", "o_orderstatus")


@query("a33_apportion", """
WITH w AS (SELECT l_orderkey, sum(l_quantity) AS w FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, l_linenumber, l_partkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_totalprice * l_quantity / w END AS apportioned
FROM lineitem l JOIN w ON w.l_orderkey = l.l_orderkey JOIN orders ON o_orderkey = l.l_orderkey""")
def a33(t):
    amounts = t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                              F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice")).otherwise(0.0).alias("amount"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(amounts, "l_orderkey")
    return ops.apportion(lines, ["l_orderkey"], "l_quantity", "amount").select("l_orderkey", "l_linenumber", "l_partkey", "apportioned")


@query("a34_pivot_checked", """
WITH c AS (SELECT l_partkey, l_returnflag AS f, arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS v, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2)
SELECT l_partkey, max(v) FILTER (f = 'A') AS A, max(v) FILTER (f = 'R') AS R, CAST(count_if(lo <> hi) AS BIGINT) AS conflicts FROM c GROUP BY 1""")
def a34(t):
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    wide, problems = ops.pivot_checked(t.lineitem, "l_partkey", "l_returnflag", "l_extendedprice", order, ["A", "R"])
    counts = problems.groupBy("l_partkey").agg(F.count("*").alias("conflicts"))
    return wide.join(counts, "l_partkey", "left").na.fill(0, ["conflicts"])


@query("a35_name_index", """
SELECT p_name, count(DISTINCT p_brand) AS containers, min(p_brand) AS first_container FROM part GROUP BY 1""")
def a35(t):
    return ops.name_index(t.part, "p_name", "p_brand")


@query("u03_multiset", """
WITH a AS (SELECT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier)
SELECT 'both' AS side, k FROM (SELECT k FROM a INTERSECT ALL SELECT k FROM b) UNION ALL SELECT 'left', k FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b)""")
def u03(t):
    a = t.orders.select(F.col("o_custkey").alias("k"))
    b = t.customer.select(F.col("c_custkey").alias("k")).unionByName(t.supplier.select(F.col("s_suppkey").alias("k")))
    return a.intersectAll(b).select(F.lit("both").alias("side"), "k").unionByName(a.exceptAll(b).select(F.lit("left").alias("side"), "k"))


