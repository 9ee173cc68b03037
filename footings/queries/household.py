"""Household arithmetic over the whole order and line tables.

An order total stands for an assessed value, thousands of units for gallons, and
the order priority for the side of the town limits.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.functions import household as hh
from footings.queries.registry import query

TOWN, COUNTY = 51.3, 67.58


def households(t):
    return t.orders.select(
        "o_orderkey", F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderpriority") < "3", "intown").otherwise("outoftown").alias("location"),
        F.when(F.col("o_orderstatus") != "P", F.lit(TOWN)).alias("town"),
        F.when(F.col("o_custkey") % 10 != 0, F.lit(COUNTY)).alias("county"))


HOUSEHOLDS = """
h AS (SELECT o_orderkey, o_totalprice AS value, o_orderpriority < '3' AS inside,
             CASE WHEN o_orderstatus <> 'P' THEN 51.3::DOUBLE END AS town,
             CASE WHEN o_custkey % 10 <> 0 THEN 67.58::DOUBLE END AS county FROM orders)"""


@query("f18_tax_on_value", f"""
WITH {HOUSEHOLDS} SELECT o_orderkey, value / 100 * (town / 100) AS tax FROM h""")
def f18(t):
    return households(t).select("o_orderkey",
                                hh.tax_on_value(F.col("value"), F.col("town")).alias("tax"))


@query("f19_property_tax_bill", f"""
WITH {HOUSEHOLDS}, s AS (
  SELECT o_orderkey, inside,
         CASE WHEN inside THEN floor(value / 100 * (town / 100) + 0.5) ELSE 0 END AS town_due,
         floor(value / 100 * (county / 100) + 0.5) AS county_due FROM h)
SELECT o_orderkey, inside AS town_applies, town_due::DOUBLE AS town_due, county_due::DOUBLE AS county_due,
       (town_due + county_due)::DOUBLE AS total, (town_due + county_due)::DOUBLE / 12 AS monthly,
       (town_due IS NOT NULL AND county_due IS NOT NULL) AS complete FROM s""")
def f19(t):
    bill = hh.property_tax_bill(F.col("value"), F.col("location"), F.col("town"), F.col("county"))
    return households(t).select(
        "o_orderkey", bill["town"]["applies"].alias("town_applies"),
        bill["town"]["rounded"].alias("town_due"), bill["county"]["rounded"].alias("county_due"),
        bill["total"].alias("total"), bill["monthly"].alias("monthly"),
        bill["complete"].alias("complete"))


@query("f20_policy_dollars", f"""
WITH {HOUSEHOLDS} SELECT o_orderkey, CASE WHEN inside THEN value / 100 * 0.01::DOUBLE * town END AS dollars FROM h""")
def f20(t):
    return households(t).select("o_orderkey", hh.policy_dollars(
        F.col("value"), F.col("location"), F.col("town")).alias("dollars"))


@query("f21_annual_change", f"""
WITH {HOUSEHOLDS} SELECT o_orderkey,
  coalesce(CASE WHEN inside THEN value / 100 * 0.01::DOUBLE * town END, 0)
  + coalesce(value / 100 * 0.01::DOUBLE * county, 0) + 7.5::DOUBLE * 12 AS total FROM h""")
def f21(t):
    change = hh.annual_change(F.col("value"), F.col("location"), F.col("town"), F.col("county"),
                              F.lit(7.5))
    return households(t).select("o_orderkey", change["total"].alias("total"))


@query("f24_applicable_rates", f"""
WITH {HOUSEHOLDS}, r AS (SELECT o_orderkey, CASE WHEN inside THEN town END AS town, county FROM h)
SELECT o_orderkey, CAST((town IS NOT NULL)::INT + (county IS NOT NULL)::INT AS INTEGER) AS n_rates,
       CASE WHEN town IS NULL AND county IS NULL THEN NULL
            ELSE 0::DOUBLE + coalesce(town, 0) + coalesce(county, 0) END AS combined FROM r""")
def f24(t):
    rates = hh.applicable_rates(F.col("location"), F.col("town"), F.col("county"))
    return households(t).select("o_orderkey", F.size(rates["rates"]).alias("n_rates"),
                                rates["combined"].alias("combined"))


@query("f25_block_bill", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_quantity > 3 THEN 28.5::DOUBLE + (l_quantity * 1000 - 3000) / 1000 * 9.5::DOUBLE
            ELSE 28.5::DOUBLE END AS bill
FROM lineitem""")
def f25(t):
    bill = hh.block_bill(F.lit(28.5), F.lit(9.5), F.lit(3000.0), F.col("l_quantity") * 1000)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", bill.alias("bill"))


@query("f25_block_bill_rounded", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(28.5 AS DECIMAL(18,4)) + CAST(greatest(l_quantity * 1000 - 3000, 0) AS DECIMAL(18,3)) * CAST(l_tax AS DECIMAL(12,4)) / 1000.0, 2) AS DOUBLE) AS bill FROM lineitem""")
def f25_rounded(t):
    bill = hh.block_bill_rounded(F.lit(28.5), F.col("l_tax"), F.lit(3000.0), F.col("l_quantity") * 1000)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", bill.alias("bill"))


def bill_columns(status):
    """Rate sets that exist for lines shipped finally, and published increases by flag."""
    def known(v):
        return F.when(status == "F", F.lit(v))

    water = {"charge_now": known(20.0), "rate_now": known(10.0), "charge_was": known(18.0),
             "rate_was": known(9.0), "threshold": F.lit(2000.0)}
    sewer = {"charge_now": known(28.0), "rate_now": known(14.0), "charge_was": known(26.0),
             "rate_was": known(13.0), "threshold": F.lit(2000.0)}
    flag = F.col("l_returnflag")
    increase = {"water_min": F.when(flag != "N", F.lit(1.86)),
                "water_avg": F.when(flag != "N", F.lit(3.72)),
                "sewer_min": F.when(flag == "A", F.lit(2.62)),
                "sewer_avg": F.when(flag == "A", F.lit(5.24))}
    return water, sewer, {"now": F.lit(96.0), "was": F.lit(84.0)}, increase


def line_bill(t):
    gallons = F.col("l_quantity") * 1000
    bill = hh.utility_bill(gallons, *bill_columns(F.col("l_linestatus")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", bill.alias("bill"))


BILLS = """
b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus = 'F' AS exact, l_returnflag AS flag,
             l_quantity * 1000 AS g,
             CASE WHEN l_quantity > 2 THEN (l_quantity * 1000 - 2000) ELSE 0 END AS over_g FROM lineitem),
c AS (SELECT *, 20::DOUBLE + over_g / 1000 * 10::DOUBLE + (28::DOUBLE + over_g / 1000 * 14::DOUBLE) + 8::DOUBLE AS now,
             18::DOUBLE + over_g / 1000 * 9::DOUBLE + (26::DOUBLE + over_g / 1000 * 13::DOUBLE) + 7::DOUBLE AS was,
             abs(g - 2000) < abs(g - 4000) AS low FROM b)"""


@query("f26_utility_bill", f"""
WITH {BILLS}
SELECT l_orderkey, l_linenumber, l_partkey, exact, exact OR flag <> 'N' AS known,
       CASE WHEN exact THEN g WHEN low THEN 2000 ELSE 4000 END::DOUBLE AS gallons,
       CASE WHEN exact THEN now END AS bill,
       CASE WHEN exact THEN now - was WHEN flag = 'N' THEN NULL
            WHEN flag = 'A' THEN CASE WHEN low THEN 1.86::DOUBLE + 2.62::DOUBLE ELSE 3.72::DOUBLE + 5.24::DOUBLE END
            ELSE CASE WHEN low THEN 1.86::DOUBLE ELSE 3.72::DOUBLE END END AS increase
FROM c""")
def f26(t):
    b = F.col("bill")
    return line_bill(t).select("l_orderkey", "l_linenumber", "l_partkey",
                               b["exact"].alias("exact"), b["known"].alias("known"),
                               b["gallons"].alias("gallons"), b["bill"].alias("bill"),
                               b["increase"].alias("increase"))


@query("f27_component_phrase", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_linestatus = 'F' THEN 'water, sewer and the stormwater fee'
            WHEN l_returnflag = 'A' THEN 'water and sewer' WHEN l_returnflag = 'N' THEN ''
            ELSE 'water' END AS phrase
FROM lineitem""")
def f27(t):
    return line_bill(t).select("l_orderkey", "l_linenumber", "l_partkey",
                               hh.component_phrase(F.col("bill")["components"]).alias("phrase"))


@query("f28_resident_total", """
WITH o AS (SELECT o_orderkey, floor(o_totalprice / 100 * (67.58::DOUBLE / 100) + 0.5)::DOUBLE AS tax,
                  o_custkey::DOUBLE * 10 AS g FROM orders),
b AS (SELECT *, 20::DOUBLE + (CASE WHEN g > 2000 THEN g - 2000 ELSE 0 END) / 1000 * 10::DOUBLE
             + (28::DOUBLE + (CASE WHEN g > 2000 THEN g - 2000 ELSE 0 END) / 1000 * 14::DOUBLE) + 8::DOUBLE AS bill FROM o)
SELECT o_orderkey, tax AS tax_annual, tax / 12 AS tax_monthly, bill AS utility_monthly,
       bill * 12 AS utility_annual, TRUE AS complete FROM b""")
def f28(t):
    tax = hh.property_tax_bill(F.col("o_totalprice"), F.lit("outoftown"), F.lit(TOWN), F.lit(COUNTY))
    rates = {"charge_now": F.lit(20.0), "rate_now": F.lit(10.0), "charge_was": F.lit(18.0),
             "rate_was": F.lit(9.0), "threshold": F.lit(2000.0)}
    sewer = {**rates, "charge_now": F.lit(28.0), "rate_now": F.lit(14.0)}
    none = F.lit(None).cast("double")
    utility = hh.utility_bill(F.col("o_custkey").cast("double") * 10, rates, sewer,
                              {"now": F.lit(96.0), "was": F.lit(84.0)},
                              dict.fromkeys(("water_min", "water_avg", "sewer_min", "sewer_avg"), none))
    year = hh.resident_total(tax, utility)
    return t.orders.select("o_orderkey", *[year[c].alias(c) for c in (
        "tax_annual", "tax_monthly", "complete", "utility_monthly", "utility_annual")])


@query("f29_clamp", """
SELECT o_orderkey, least(1e9::DOUBLE, greatest(1000::DOUBLE, o_totalprice - 200000)) AS home,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE least(200000::DOUBLE, greatest(0::DOUBLE, o_totalprice)) END AS gallons
FROM orders""")
def f29(t):
    return t.orders.select(
        "o_orderkey", hh.clamp(F.col("o_totalprice") - 200000, "home").alias("home"),
        hh.clamp(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")), "gallons")
        .alias("gallons"))


@query("f26_utility_bill_parts", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 100 AS g, l_linestatus = 'F' AS f FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN f THEN 20 + greatest(g - 2000, 0) / 1000 * 10 END AS water_now, CASE WHEN f THEN (20 + greatest(g - 2000, 0) / 1000 * 10) - (18 + greatest(g - 2000, 0) / 1000 * 9) END AS water_delta,
  30 + greatest(g - 2000, 0) / 1000 * 12 AS sewer_now, (30 + greatest(g - 2000, 0) / 1000 * 12) - (27 + greatest(g - 2000, 0) / 1000 * 11) AS sewer_delta, 120 / 12.0::DOUBLE - 96 / 12.0::DOUBLE AS storm_delta,
  CAST(2027 AS INTEGER) AS rate_year, CAST(2026 AS INTEGER) AS previous_year FROM c""")
def f26_parts(t):
    """Parts and differences of each service; a service without rates has none."""
    known = F.when(F.col("l_linestatus") == "F", F.lit(1.0))
    water = {"charge_now": known * 20, "rate_now": known * 10, "charge_was": known * 18, "rate_was": known * 9, "threshold": F.lit(2000.0)}
    sewer = {"charge_now": F.lit(30.0), "rate_now": F.lit(12.0), "charge_was": F.lit(27.0), "rate_was": F.lit(11.0), "threshold": F.lit(2000.0)}
    parts = hh.utility_bill_parts(F.col("l_quantity") * 100, water, sewer, {"now": F.lit(120.0), "was": F.lit(96.0)}, {"now": F.lit(2027), "was": F.lit(2026)})
    p = F.col("p")
    return t.lineitem.withColumn("p", parts).select(
        "l_orderkey", "l_linenumber", "l_partkey", p["water"]["now"].alias("water_now"), p["water"]["delta"].alias("water_delta"), p["sewer"]["now"].alias("sewer_now"),
        p["sewer"]["delta"].alias("sewer_delta"), p["stormwater"]["delta"].alias("storm_delta"), p["rate_year"].alias("rate_year"), p["previous_year"].alias("previous_year"))
