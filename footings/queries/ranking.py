"""Orders, limits and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.operators import ranking as ops
from footings.queries.registry import query


@query("t01_ranked", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer ORDER BY coalesce(balance, 0) DESC, c_custkey")
def t01(t):
    return ops.ranked(t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")),
                      "balance", ["c_custkey"])


@query("t02_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def t02(t):
    return ops.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query("t03_sample_per_group", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) <= 3""")
def t03(t):
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")]
    return ops.sample_per_group(t.lineitem, ["l_orderkey"], order, 3).select("l_orderkey", "l_linenumber", "l_partkey")


@query("t04_order_last", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1 ORDER BY c_mktsegment = 'BUILDING', 1")
def t04(t):
    return ops.order_last(t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("customers")), "c_mktsegment", "BUILDING")


@query("t05_arg_extreme", """
SELECT c_mktsegment, arg_min(c_acctbal, (c_acctbal, c_custkey)) AS c_acctbal, arg_min(c_custkey, (c_acctbal, c_custkey)) AS c_custkey, arg_min(c_name, (c_acctbal, c_custkey)) AS c_name
FROM customer WHERE c_acctbal > 0 GROUP BY 1""")
def t05(t):
    return ops.arg_extreme(t.customer.filter("c_acctbal > 0"), ["c_mktsegment"], "c_acctbal", "c_custkey", ["c_name"])


@query("u01_merge_facts", """
SELECT 'customer' AS stage, c_custkey AS id, c_acctbal AS value FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part""")
def u01(t):
    def stage(df, name, key, value):
        return df.select(F.lit(name).alias("stage"), F.col(key).alias("id"), F.col(value).alias("value"))

    return ops.merge_facts([stage(t.customer, "customer", "c_custkey", "c_acctbal"),
                            stage(t.supplier, "supplier", "s_suppkey", "s_acctbal"),
                            stage(t.part, "part", "p_partkey", "p_retailprice")])


@query("u02_keys", """
SELECT 'both' AS side, k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION ALL SELECT 'only', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)""")
def u02(t):
    a = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    b = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"))
    only = ops.keys_only(t.customer.select(F.col("c_custkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k")))
    return ops.keys_both(a, b).select(F.lit("both").alias("side"), "k").unionByName(only.select(F.lit("only").alias("side"), "k"))


@query("u04_append_scenario", """
WITH a AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, 'Actual' AS scenario, o_orderkey FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER), CASE WHEN o_orderstatus = 'O' THEN 'Estimate' ELSE 'Actual' END, o_orderkey FROM orders WHERE o_orderstatus <> 'F'),
c AS (SELECT o_custkey, year, scenario, count(*) AS n FROM a GROUP BY ALL)
SELECT a.*, n > 1 AS collides FROM a JOIN c USING (o_custkey, year, scenario)""")
def u04(t):
    def rows(df, scenario):
        return df.select("o_custkey", F.year("o_orderdate").alias("year"), scenario.alias("scenario"), "o_orderkey")

    held = rows(t.orders.filter("o_orderstatus = 'F'"), F.lit("Actual"))
    new = rows(t.orders.filter("o_orderstatus <> 'F'"), F.when(F.col("o_orderstatus") == "O", "Estimate").otherwise("Actual"))
    grain = ["o_custkey", "year", "scenario"]
    both, clash = ops.append_scenario(held, new, grain)
    return both.join(clash, grain, "left").withColumn("collides", F.col("rows").isNotNull()).drop("rows")
