"""Joins and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.functions.text import tokens
from footings.operators import joins as ops
from footings.queries.registry import query


def d(expr):
    return F.col(expr).cast("decimal(18,2)") if isinstance(expr, str) else expr.cast("decimal(18,2)")


@query("j01_orphans", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')""")
def j01(t):
    dim = t.part.filter("p_type <> 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    return ops.orphans(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), dim, "l_partkey")


@query("j02_with_document", """
SELECT o_orderkey, c_mktsegment, coalesce(c_nationkey, 0) AS c_nationkey
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def j02(t):
    docs = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return ops.with_document(t.orders.select("o_orderkey", "o_custkey"), docs, "o_custkey", "c_nationkey") \
        .select("o_orderkey", "c_mktsegment", "c_nationkey")


def reconciliation(t):
    """Line prices per order against a printed total that is off by the customer number."""
    key = F.col("l_orderkey").alias("orderkey")
    detail = t.lineitem.select(key, F.col("l_extendedprice").alias("amount"))
    slip = t.orders.select(F.col("o_orderkey").alias("orderkey"), (F.col("o_custkey") % 40).alias("off"),
                           "o_orderstatus")
    sums = t.lineitem.groupBy(key).agg(F.sum(d("l_extendedprice")).cast("double").alias("s"))
    published = sums.join(slip, "orderkey").select(
        "orderkey", F.round(F.col("s") + F.when(F.col("off") < 30, F.col("off")).otherwise(F.col("off") * 100), 2)
        .alias("amount"))
    known = slip.filter("off = 20").select("orderkey", F.lit(-20.0).alias("amount"), F.lit("unit above grain").alias("why"))
    disclosed = slip.filter("off >= 35").select("orderkey", (F.col("off") * -100.0 + F.when(
        F.col("off") == 39, 500).otherwise(2)).alias("amount"), F.lit("cause not established").alias("why"))
    return ops.reconcile_published(detail, published, ["orderkey"], "amount", known=known, disclosed=disclosed)


RECONCILED = """
r AS (SELECT o_orderkey AS orderkey, o_orderstatus, o_custkey % 40 AS off,
             CASE WHEN o_custkey % 40 < 30 THEN o_custkey % 40 ELSE o_custkey % 40 * 100 END AS gap
      FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
c AS (SELECT *, gap <= 10 OR off = 20 AS ok, off BETWEEN 35 AND 38 AS disclosed FROM r)"""


@query("j03_reconcile_published", f"""
WITH {RECONCILED}
SELECT orderkey, -gap::DOUBLE AS difference, ok AS reconciles, ok AS verified,
  CASE WHEN off = 20 THEN 'known source variance' WHEN ok THEN 'reconciles' WHEN disclosed THEN 'disclosed, unexplained' ELSE 'UNEXPLAINED' END AS status,
  CASE WHEN off = 20 THEN 'unit above grain' WHEN NOT ok AND disclosed THEN 'cause not established' END AS explanation
FROM c""")
def j03(t):
    return reconciliation(t).select("orderkey", "difference", "reconciles", "verified", "status", "explanation")


@query("a09_verified_slices", f"""
WITH {RECONCILED}
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS priority, bool_and(ok) AS verified,
       count(*) AS checks, CAST(count_if(ok) AS BIGINT) AS reconciled
FROM c JOIN orders ON o_orderkey = orderkey GROUP BY 1, 2""")
def a09(t):
    """Which (year, priority) slices may be shown: every total inside must verify."""
    from footings.operators.aggregates import verified_slices

    slices = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.year("o_orderdate").alias("year"),
                             F.col("o_orderpriority").alias("priority"))
    return verified_slices(reconciliation(t).join(slices, "orderkey"), ["year", "priority"])


def two_readings(t):
    """One reading misses returned lines and misreads suppliers divisible by nine."""
    base = t.lineitem.select(
        F.year("l_shipdate").alias("year"), "l_orderkey", "l_linenumber", "l_partkey",
        F.concat_ws("/", F.col("l_suppkey"), F.format_number("l_quantity", 0), F.format_number("l_extendedprice", 2)).alias("ordinal"),
        "l_returnflag", "l_suppkey", F.col("l_extendedprice").alias("value"))
    left = base.filter("l_returnflag <> 'R' or year < 2000")
    right = base.filter("year > 1995 and (l_returnflag <> 'N' or l_suppkey < 50)").withColumn(
        "value", F.when(F.col("l_suppkey") % 9 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return left, right


@query("j04_compare_readings", """
WITH base AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_orderkey, l_linenumber, l_partkey,
                l_suppkey || '/' || CAST(l_quantity AS INTEGER) || '/' ||
                CASE WHEN l_extendedprice >= 1000 THEN CAST(floor(l_extendedprice / 1000) AS INTEGER) || ',' || right(printf('%.2f', l_extendedprice), 6) ELSE printf('%.2f', l_extendedprice) END AS ordinal,
                l_returnflag, l_suppkey, l_extendedprice AS value FROM lineitem),
a AS (SELECT year, l_orderkey, l_linenumber, l_partkey, arg_min(value, ordinal) AS v FROM base WHERE l_returnflag <> 'R' OR year < 2000 GROUP BY ALL),
b AS (SELECT year, l_orderkey, l_linenumber, l_partkey, arg_min(CASE WHEN l_suppkey % 9 = 0 THEN value + 1 ELSE value END, ordinal) AS v FROM base
      WHERE year > 1995 AND (l_returnflag <> 'N' OR l_suppkey < 50) GROUP BY ALL),
j AS (SELECT coalesce(a.year, b.year) AS year, a.v AS av, b.v AS bv FROM a FULL JOIN b
      ON a.year = b.year AND a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_partkey = b.l_partkey)
SELECT year, CAST(count_if(abs(av - bv) < 0.5) AS BIGINT) AS agree, CAST(count_if(abs(av - bv) >= 0.5) AS BIGINT) AS disagree,
       CAST(count_if(bv IS NULL) AS BIGINT) AS only_left, CAST(count_if(av IS NULL) AS BIGINT) AS only_right,
       round(CAST(count_if(abs(av - bv) < 0.5) AS DOUBLE) * 100 / (count_if(abs(av - bv) < 0.5) + count_if(abs(av - bv) >= 0.5)), 2) AS agreement_pct
FROM j WHERE year IN (SELECT year FROM a) AND year IN (SELECT year FROM b) GROUP BY year""")
def j04(t):
    left, right = two_readings(t)
    cells = ops.compare_readings(left, right, ["year", "l_orderkey", "l_linenumber", "l_partkey"],
                                 "year", "value", "ordinal")
    return ops.readings_by_year(cells, "year")


@query("j05_authoritative", """
WITH k AS (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END AS r FROM orders),
b AS (SELECT o_custkey, year(o_orderdate) AS y, arg_min(o_orderstatus, (r, o_orderkey)) AS s FROM k GROUP BY 1, 2)
SELECT o_orderkey FROM k JOIN b ON b.o_custkey = k.o_custkey AND b.y = year(k.o_orderdate) AND b.s = k.o_orderstatus""")
def j05(t):
    kinds = {"1-URGENT": "digital-own", "2-HIGH": "digital-comparative", "3-MEDIUM": "scan-own"}
    readings = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), "o_orderstatus",
                               F.coalesce(ops.lookup(F.col("o_orderpriority"), kinds), F.lit("other")).alias("kind"))
    return ops.authoritative(readings, ["o_custkey", "year"], "o_orderstatus", "kind", "o_orderkey") \
        .select("o_orderkey")


@query("j06_exclude_years", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE month(o_orderdate) = 12)""")
def j06(t):
    held = t.orders.filter("month(o_orderdate) = 12").select(F.year("o_orderdate").alias("year"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("year"))
    return ops.exclude_years(lines, held, "year").drop("year")


RATIO = """
a AS (SELECT o_custkey AS k, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS l FROM orders GROUP BY 1),
r AS (SELECT k, l, CASE WHEN k % 7 = 0 THEN l / 10 + 1 ELSE l / 10 END AS s FROM a)"""


def ratios(t):
    rates = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.sum(d("o_totalprice")).cast("double").alias("l"))
    tenth = rates.select("k", F.when(F.col("k") % 7 == 0, F.col("l") / 10 + 1).otherwise(F.col("l") / 10).alias("s"))
    return ops.ratio_test(rates, tenth, "k", "l", "s", 10.0)


@query("j07_ratio_test", f"WITH {RATIO} SELECT k, l, s, round(l / s, 6) AS ratio, k % 7 <> 0 AS exact FROM r")
def j07(t):
    return ratios(t)


@query("j07_ratio_proven", f"WITH {RATIO} SELECT bool_and(k % 7 <> 0) AS proven, count(*) AS tested FROM r")
def j07_proven(t):
    return ops.all_proven(ratios(t))


@query("j08_merge_series", """
WITH c AS (SELECT c_nationkey AS k, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) FILTER (c_nationkey % 4 <> 0) AS DOUBLE) AS v FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS k, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) FILTER (s_nationkey % 3 <> 0) AS DOUBLE) AS v FROM supplier GROUP BY 1),
f AS (SELECT n_nationkey AS k, CASE WHEN n_regionkey = 1 THEN 1.5::DOUBLE END AS v FROM nation),
j AS (SELECT coalesce(c.k, s.k, f.k) AS nationkey, c.v AS county, coalesce(s.v, f.v) AS town, f.v AS forward
      FROM c FULL JOIN s ON c.k = s.k FULL JOIN f ON f.k = coalesce(c.k, s.k))
SELECT nationkey, county, town, forward, round(county + town, 6) AS combined,
       CASE WHEN county IS NULL AND town IS NOT NULL THEN 'no county' WHEN county IS NOT NULL AND town IS NULL THEN 'no town' END AS incomplete FROM j""")
def j08(t):
    county = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")) \
        .agg(F.sum(F.when(F.col("c_nationkey") % 4 != 0, d("c_acctbal"))).cast("double").alias("value"))
    town = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")) \
        .agg(F.sum(F.when(F.col("s_nationkey") % 3 != 0, d("s_acctbal"))).cast("double").alias("value"))
    forward = t.nation.select(F.col("n_nationkey").alias("nationkey"), F.when(F.col("n_regionkey") == 1, 1.5).alias("value"))
    return ops.merge_series({"county": county, "town": town, "forward": forward}, "nationkey",
                            ["county", "town"], {"town": "forward"})


@query("j09_verify_on_page", """
WITH p AS (SELECT DISTINCT l_orderkey AS k, round_even(abs(l_extendedprice), 0) AS f FROM lineitem WHERE l_returnflag <> 'R'),
w AS (SELECT l_orderkey AS k, l_linenumber, l_partkey, l_suppkey, l_quantity, unnest([l_extendedprice, l_quantity * l_linenumber, 0]) AS v FROM lineitem),
j AS (SELECT w.*, round_even(abs(v), 0) AS f, p.f IS NULL AS missed, w.k IN (SELECT k FROM p) AS seen
      FROM w LEFT JOIN p ON p.k = w.k AND p.f = round_even(abs(w.v), 0) WHERE v <> 0)
SELECT k AS orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, count(*) AS figures,
  CASE WHEN NOT bool_or(seen) THEN 'unverifiable' WHEN bool_or(missed) THEN 'NOT FOUND on the cited page' ELSE 'every figure found' END AS verification,
  CASE WHEN bool_or(seen) THEN CAST(count_if(missed) AS BIGINT) END AS not_found,
  CASE WHEN bool_or(seen) THEN max(f) FILTER (missed) END AS largest_missing
FROM j GROUP BY ALL""")
def j09(t):
    key = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    rows = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), *key, F.array(
        F.col("l_extendedprice"), F.col("l_quantity") * F.col("l_linenumber"), F.lit(0.0)).alias("figures"))
    page = t.lineitem.filter("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("orderkey"),
                                                          F.col("l_extendedprice").alias("figure"))
    return ops.verify_on_page(rows, page, ["orderkey", *key], ["orderkey"], "figures")


@query("j10_corroborate_values", """
WITH r AS (SELECT o_orderkey, year(o_orderdate) AS y, unnest([o_totalprice, 900, floor(o_totalprice)]) AS v FROM orders),
p AS (SELECT DISTINCT year(l_shipdate) AS y, round(abs(l_extendedprice), 2) AS v FROM lineitem
      UNION SELECT year(o_orderdate), round(abs(floor(o_totalprice)), 2) FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, count(*) AS checked, count(p.v) AS corroborated
FROM r LEFT JOIN p ON p.y = r.y AND p.v = round(abs(r.v), 2) GROUP BY 1""")
def j10(t):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("a"),
                           F.lit(900.0).alias("b"), F.floor("o_totalprice").cast("double").alias("c"))
    published = t.lineitem.select(F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("v")).unionByName(
        t.orders.filter("o_orderstatus = 'F'").select(F.year("o_orderdate").alias("year"),
                                                      F.floor("o_totalprice").cast("double").alias("v")))
    return ops.corroborate_values(rows, published, ["o_orderkey"], "year", ["a", "b", "c"], "v")


@query("j11_match_total", """
WITH q AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderpriority AS s, o_totalprice AS a FROM orders),
h AS (SELECT q.o_orderkey, min(l.l_orderkey) AS k FROM q JOIN (SELECT l_orderkey, year(l_shipdate) AS y, l_extendedprice AS v FROM lineitem
        UNION ALL SELECT o_orderkey + 7, y, CASE WHEN o_orderkey % 2 = 0 THEN a + 0.004 ELSE a + 0.006 END FROM q) l
      ON l.y = q.y AND l.v BETWEEN q.a - 0.01 AND q.a + 0.01 AND abs(l.v - q.a) < 0.005 GROUP BY 1)
SELECT q.o_orderkey, h.k IS NOT NULL AS found, h.k AS found_document FROM q LEFT JOIN h USING (o_orderkey)""")
def j11(t):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("amount"))
    printed = t.lineitem.select(F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("total"),
                                F.col("l_orderkey").alias("document")).unionByName(rows.select(
        "year", (F.col("amount") + F.when(F.col("o_orderkey") % 2 == 0, 0.004).otherwise(0.006)).alias("total"),
        (F.col("o_orderkey") + 7).alias("document"))).withColumn("ordinal", F.col("document"))
    return ops.match_total(rows, printed, ["year"], "o_orderkey", "amount", "total", "ordinal", ["document"]) \
        .select("o_orderkey", "found", "found_document")


@query("j12_assign_nearest", """
WITH p AS (SELECT event_id, user_id, CAST(day(ts) AS INTEGER) AS day, value AS x FROM events),
n AS (SELECT event_id, user_id, day, x, least(greatest(round(x / 25), 0), 20) AS c FROM p),
m AS (SELECT event_id, user_id, day, x, CASE WHEN ceil(x / 25 - 0.5) <= 20 THEN CAST(ceil(x / 25 - 0.5) AS INTEGER) ELSE 20 END AS c FROM n),
k AS (SELECT *, abs(x - c * 25) <= 6 AS near FROM m),
f AS (SELECT user_id, day, c, min(event_id) AS event_id FROM k WHERE near GROUP BY 1, 2, 3)
SELECT k.event_id, k.user_id, k.day, CASE WHEN f.event_id IS NOT NULL THEN k.c END AS assigned
FROM k LEFT JOIN f ON f.event_id = k.event_id""")
def j12(t):
    """Event values against a grid of 21 edges, 25 apart, within 6; one per user, day and column."""
    points = t.events.select("user_id", F.dayofmonth("ts").alias("day"), "event_id", F.col("value").alias("x"))
    users = t.events.select("user_id").distinct()
    edges = users.select("user_id", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("column")) \
        .withColumn("edge", F.col("column") * 25.0)
    return ops.assign_nearest(points, edges, ["user_id"], "day", "event_id", "x", "column", "edge", 6.0) \
        .select("event_id", "user_id", "day", "assigned")


@query("j13_pair_by_identity", """
WITH a AS (SELECT DISTINCT p_brand, p_type, p_size AS v1 FROM part), b AS (SELECT DISTINCT p_brand, p_type, p_retailprice AS v2 FROM part),
q AS (SELECT a.p_brand, a.p_type, a.v1::DOUBLE AS v1, b.v2 FROM a JOIN b ON a.p_brand = b.p_brand AND a.p_type = b.p_type
      AND abs(a.v1 - b.v2 * 0.0205::DOUBLE) <= 0.02 + 1e-9),
g AS (SELECT p_brand, p_type, count(*) AS pairs, min(v2) AS lo, arg_min(v1, (v2, v1)) AS lo1, max(v2) AS hi, arg_max(v1, (v2, v1)) AS hi1 FROM q GROUP BY 1, 2)
SELECT p_brand, p_type, pairs, pairs = 2 AS accepted, CASE WHEN pairs = 2 THEN lo END AS current_rate, CASE WHEN pairs = 2 THEN lo1 END AS current_charge,
  CASE WHEN pairs = 2 THEN hi END AS recommended_rate, CASE WHEN pairs = 2 THEN hi1 END AS recommended_charge,
  CASE WHEN pairs = 2 THEN round((hi / lo - 1) * 100, 2) END AS increase_pct FROM g""")
def j13(t):
    sizes = t.part.select("p_brand", "p_type", F.col("p_size").cast("double").alias("v1"))
    prices = t.part.select("p_brand", "p_type", F.col("p_retailprice").alias("v2"))
    return ops.pair_by_identity(sizes, prices, ["p_brand", "p_type"], "v1", "v2", 0.0205)


NAMES = """
l AS (SELECT p_partkey, p_name || ' ' || lower(p_type) AS nm, list_distinct(string_split(p_name || ' ' || lower(p_type), ' ')) AS lt FROM part),
r AS (SELECT p_partkey AS k, CASE WHEN p_type = 'ECONOMY' THEN p_name || ' economy deluxe' WHEN p_brand = 'Brand#7' THEN 'The ' || p_name || ' ' || lower(p_type)
         ELSE p_name || ' ' || lower(replace(p_brand, '#', '')) END AS form,
        'see also ' || CASE WHEN p_brand = 'Brand#3' THEN p_name || ' promotional' ELSE 'nothing' END AS prose FROM part),
forms AS (SELECT form, min(k) AS k, list_distinct([x for x in string_split(lower(form), ' ') if x <> 'the']) AS rt FROM r GROUP BY form),
proses AS (SELECT prose, min(k) AS k FROM r GROUP BY prose),
names AS (SELECT DISTINCT nm, lt FROM l),
c AS (SELECT nm, 1 AS tier, 0::DOUBLE AS neg, min(k) AS k FROM names JOIN forms ON replace(nm, ' ', '') = replace(lower(form), ' ', '') GROUP BY nm
  UNION ALL SELECT nm, 2, -(len(list_intersect(lt, rt))::DOUBLE / least(len(lt), len(rt))), k FROM names, forms
     WHERE len(list_intersect(lt, rt))::DOUBLE / least(len(lt), len(rt)) >= 0.75
  UNION ALL SELECT nm, 3, 0, k FROM names, proses WHERE contains(prose, nm)),
b AS (SELECT nm, arg_min(tier, (tier, neg, k)) AS tier, arg_min(neg, (tier, neg, k)) AS neg, arg_min(k, (tier, neg, k)) AS k FROM c GROUP BY nm)"""


@query("j14_match_names", f"""
WITH {NAMES}
SELECT p_partkey, b.k AS matched_ordinal,
  CASE b.tier WHEN 1 THEN 'exact name' WHEN 2 THEN 'name variant' WHEN 3 THEN 'discussed within the form' ELSE 'no form found' END AS basis
FROM l LEFT JOIN b USING (nm)""")
def j14(t):
    left = t.part.select("p_partkey", F.concat_ws(" ", "p_name", F.lower("p_type")).alias("nm"))
    form = (F.when(F.col("p_type") == "ECONOMY", F.concat("p_name", F.lit(" economy deluxe")))
            .when(F.col("p_brand") == "Brand#7", F.concat_ws(" ", F.lit("The"), "p_name", F.lower("p_type")))
            .otherwise(F.concat_ws(" ", "p_name", F.lower(F.regexp_replace("p_brand", "#", "")))))
    prose = F.concat(F.lit("see also "), F.when(F.col("p_brand") == "Brand#3", F.concat("p_name", F.lit(" promotional")))
                     .otherwise("nothing"))
    right = t.part.select(F.col("p_partkey").alias("k"), form.alias("form"), prose.alias("prose"))
    return ops.match_names(left, right, "nm", "form", "prose", "k", lambda c: tokens(c, [], ["the"])) \
        .select("p_partkey", "matched_ordinal", "basis")


def snapshots(t):
    old = t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", F.sha2("c_name", 256).alias("sha"))
    new = t.customer.filter("c_nationkey <> 3").select("c_custkey", F.sha2(
        F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name")), 256).alias("sha"))
    return ops.diff_snapshots(old, new, "c_custkey", "sha")


DIFF = """
d AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'added' WHEN c_nationkey = 3 THEN 'removed'
        WHEN c_acctbal < 0 THEN 'changed' ELSE 'unchanged' END AS change FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_nationkey <> 3)"""


@query("j15_diff_snapshots", f"WITH {DIFF} SELECT * FROM d")
def j15(t):
    return snapshots(t)


@query("j15_at_risk", f"""
WITH {DIFF} SELECT c_custkey, count(*) AS facts_at_risk FROM orders JOIN d ON o_custkey = c_custkey
WHERE change IN ('changed', 'removed') GROUP BY 1""")
def j15_risk(t):
    return ops.at_risk(snapshots(t), t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("j16_cross_total", """
WITH p AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus AS section, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, l_returnflag AS f FROM lineitem),
x AS (SELECT year, section, CAST(sum(v) AS DOUBLE) AS published, CAST(sum(v) FILTER (f = 'R') AS DOUBLE) AS adjustment,
             CAST(sum(v) FILTER (f <> 'R') AS DOUBLE) + CASE WHEN year % 2 = 0 THEN 5 ELSE 1 END AS audited FROM p GROUP BY 1, 2)
SELECT year, section, published, adjustment, audited, round(published - adjustment - audited, 2) AS difference, year % 2 = 1 AS agree FROM x""")
def j16(t):
    lines = t.lineitem.select(F.year("l_shipdate").alias("year"), F.col("l_linestatus").alias("section"),
                              F.col("l_extendedprice").alias("v"), "l_returnflag")
    slip = lines.select("year", "section").distinct().select(
        "year", "section", F.when(F.col("year") % 2 == 0, 5.0).otherwise(1.0).alias("v"))
    audited = lines.filter("l_returnflag <> 'R'").select("year", "section", "v").unionByName(slip)
    return ops.cross_total(lines, audited, ["year", "section"], "v", F.col("l_returnflag") == "R")


@query("j17_compare_workbook", """
WITH f AS (SELECT o_custkey, o_totalprice, (CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 9 END, -epoch(o_orderdate), o_orderkey) AS k FROM orders),
m AS (SELECT o_custkey, arg_min(o_totalprice, k) AS ours, count(*) AS readings, min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM f GROUP BY 1)
SELECT o_custkey, ours AS theirs_base, ours, readings, lowest, highest, round(ours * (1 + (o_custkey % 3) * 0.004) - ours, 2) AS difference,
  o_custkey % 3 < 2 OR abs(ours * 0.008) <= 1 AS agrees, readings > 1 AS documents_disagree FROM m""")
def j17(t):
    order = [ops.lookup(F.col("o_orderpriority"), {"1-URGENT": 0, "2-HIGH": 1}), -F.unix_timestamp("o_orderdate"), F.col("o_orderkey")]
    order[0] = F.coalesce(order[0], F.lit(9))
    facts = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate", F.col("o_totalprice").alias("v"))
    best = facts.groupBy("o_custkey").agg(F.min(F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)], "v"))["v"].alias("v"))
    theirs = best.withColumn("v", F.col("v") * (1 + (F.col("o_custkey") % 3) * 0.004))
    out = ops.compare_workbook(theirs, facts, ["o_custkey"], "v", order)
    return out.withColumn("theirs_base", F.col("ours")).drop("theirs")


@query("j18_route_statement_lines", """
WITH c AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus AS s, o_custkey % 2 = 0 AS sub, o_totalprice AS v FROM orders)
SELECT o_orderkey, y AS year, 'Adopted' AS scenario, CASE WHEN sub THEN 'fund_total' ELSE 'amount' END AS measure, v AS amount FROM c WHERE s <> 'P'
UNION ALL SELECT o_orderkey, y, 'Actual', CASE WHEN sub THEN 'fund_total' ELSE 'amount' END, v * 2 FROM c WHERE s <> 'P'
UNION ALL SELECT o_orderkey, y - 1, 'Actual', CASE WHEN sub THEN 'fund_total' ELSE 'amount' END, v * 4 FROM c WHERE s = 'F'
UNION ALL SELECT o_orderkey, y, 'Adopted', CASE WHEN sub THEN 'fund_total_original_budget' ELSE 'amount_original_budget' END, v * 4 FROM c WHERE s = 'O'
UNION ALL SELECT o_orderkey, y, '(basis unknown)', CAST(i AS VARCHAR), v * m FROM c, (VALUES (0, 1), (1, 2), (2, 3), (3, 4)) x(i, m) WHERE s = 'P'""")
def j18(t):
    v = F.col("o_totalprice")
    four = F.when(F.col("o_orderstatus") == "F", "prior_year_actual").otherwise("original_budget")
    roles = F.when(F.col("o_orderstatus") != "P", F.create_map(
        F.lit("0"), F.lit("budget"), F.lit("1"), F.lit("actual"), F.lit("2"), F.lit("variance"), F.lit("3"), four))
    lines = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), roles.alias("column_roles"),
                            (F.col("o_custkey") % 2 == 0).alias("is_subtotal"),
                            F.array(v, v * 2, v * 3, v * 4, F.lit(None).cast("double")).alias("values"))
    financial, unknown = ops.route_statement_lines(lines, ["o_orderkey"], "year")
    return financial.select("o_orderkey", "year", "scenario", "measure", "amount").unionByName(unknown.select(
        "o_orderkey", "year", F.lit("(basis unknown)").alias("scenario"),
        F.col("column_index").cast("string").alias("measure"), "amount"))


@query("j19_overlay", """
WITH c AS (SELECT c_custkey AS k, c_acctbal AS hi, CASE WHEN c_nationkey % 5 <> 0 THEN c_acctbal END AS lo FROM customer),
s AS (SELECT o_custkey AS k, max(o_totalprice) AS hi, min(o_totalprice) AS lo FROM orders GROUP BY 1)
SELECT coalesce(c.k, s.k) AS custkey, CASE WHEN s.k IS NULL THEN 'base' ELSE 'preferred' END AS how,
  CASE WHEN s.k IS NULL THEN c.hi ELSE s.hi END AS hi, CASE WHEN s.k IS NULL THEN c.lo ELSE s.lo END AS lo,
  CAST(CASE WHEN s.k IS NULL AND c.lo IS NULL THEN 1 ELSE 0 END AS INTEGER) AS blanks FROM c FULL JOIN s ON c.k = s.k""")
def j19(t):
    base = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("hi"),
                             F.when(F.col("c_nationkey") % 5 != 0, F.col("c_acctbal")).alias("lo"))
    best = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"))
    return ops.overlay(base, best, "custkey", ["hi", "lo"])


@query("j20_timeline", """
WITH l AS (SELECT event_type AS m, CAST(day(ts) AS INTEGER) AS day, arg_max(value, (ts, -event_id)) AS v FROM events GROUP BY 1, 2),
p AS (SELECT day, max(v) FILTER (m = 'purchase') - 40 AS main, max(v) FILTER (m = 'view') AS gap, max(v) FILTER (m = 'error') AS level FROM l GROUP BY 1)
SELECT day, main, gap, level, main < 0 AND abs(coalesce(gap, 0)) > 8 AS flag, CASE WHEN day = 20 THEN 'worked example' END AS scenario
FROM p WHERE main IS NOT NULL AND day >= 10""")
def j20(t):
    from footings.operators.windows import latest_by

    events = t.events.select(F.col("event_type").alias("metric"), F.dayofmonth("ts").alias("day"), "ts", "event_id",
                             F.when(F.col("event_type") == "purchase", F.col("value") - 40).otherwise(F.col("value")).alias("value"))
    latest = latest_by(events, ["metric", "day"], F.col("ts"), F.col("event_id"))
    scenario = events.filter("day = 20").select("day", F.lit("worked example").alias("scenario")).distinct()
    return ops.timeline(latest, "metric", "day", "value", "purchase", "view", "error", 10, scenario=scenario)


@query("j21_pivot_sections", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, max_by(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'F') AS F,
  max_by(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'O') AS O, max_by(o_custkey, o_orderkey) AS o_custkey FROM orders GROUP BY 1""")
def j21(t):
    return ops.pivot_sections(t.orders.withColumn("year", F.year("o_orderdate")), "year", "o_orderstatus",
                              "o_totalprice", "o_orderkey", ["F", "O"], ["o_custkey"])
