"""Household arithmetic: property tax, block-rate utility bills.

A null is a value nobody knows.  A levy that does not reach the household is 0 with
`applies` false, so that it can be told from a levy of nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bounds a household input is held to.
LIMITS = {"home": (1000.0, 1e9), "gallons": (0.0, 200000.0)}
INSIDE = "intown"
# The two consumption levels with published increases.
LEVELS = (("min", 2000), ("avg", 4000))


def half_up(value: Column) -> Column:
    """Whole dollars, halves upwards also below zero."""
    return F.floor(value + 0.5).cast("double")


def clamp(value: Column, bounds: str) -> Column:
    """`value` cut to the range called `bounds` in LIMITS (null: null)."""
    low, high = LIMITS[bounds]
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def tax_on_value(value: Column, cents: Column) -> Column:
    """Annual dollars for `cents` per 100 dollars of value."""
    return value / 100 * (cents / 100)


def cents_on_value(value: Column, cents: Column) -> Column:
    """Annual dollars for `cents` on a rate, whoever levies it."""
    return value / 100 * 0.01 * cents


def inside(location: Column) -> Column:
    return F.coalesce(location == INSIDE, F.lit(False))


def _share(applies: Column, value: Column, cents: Column) -> Column:
    due = F.when(applies, tax_on_value(value, cents)).otherwise(F.lit(0.0))
    return F.struct(applies.alias("applies"), F.when(applies, cents).alias("rate"),
                    due.alias("due"), half_up(due).alias("rounded"),
                    (~applies | due.isNotNull()).alias("known"))


def property_tax_bill(value: Column, location: Column, town_cents: Column,
                      county_cents: Column) -> Column:
    """Town and county tax as structs; the total adds the rounded parts that apply."""
    town = _share(inside(location), value, town_cents)
    county = _share(F.lit(True), value, county_cents)
    total = town["rounded"] + county["rounded"]
    return F.struct(town.alias("town"), county.alias("county"), total.alias("total"),
                    (total / 12).alias("monthly"),
                    (town["known"] & county["known"]).alias("complete"))


def policy_dollars(value: Column, location: Column, cents: Column) -> Column:
    """`cents_on_value` of a town cent; outside the town there is none (null)."""
    return F.when(inside(location), cents_on_value(value, cents))


def annual_change(value: Column, location: Column, town_cents: Column, county_cents: Column,
                  utility_monthly: Column) -> Column:
    """Sum of the yearly differences of town, county and utility; a null difference counts 0."""
    zero = F.lit(0.0)
    town = F.coalesce(policy_dollars(value, location, town_cents), zero)
    county = F.coalesce(cents_on_value(value, county_cents), zero)
    utility = F.coalesce(utility_monthly * 12, zero)
    return F.struct(town.alias("town"), county.alias("county"), utility.alias("utility"),
                    (town + county + utility).alias("total"))


def applicable_rates(location: Column, town_cents: Column, county_cents: Column) -> Column:
    """Known rates as an array (town first) beside their sum."""
    rates = F.filter(F.array(
        F.struct(F.lit("town").alias("key"),
                 F.when(inside(location), town_cents).alias("cents")),
        F.struct(F.lit("county").alias("key"), county_cents.alias("cents"))),
        lambda r: r["cents"].isNotNull())
    combined = F.aggregate(rates, F.lit(0.0), lambda acc, r: acc + r["cents"])
    return F.struct(rates.alias("rates"), F.when(F.size(rates) > 0, combined).alias("combined"))


def block_bill(charge: Column, rate_per_1000: Column, threshold: Column, gallons: Column) -> Column:
    """Two-block bill: `charge` covers `threshold` gallons, every further 1,000 cost the rate."""
    over = F.when(gallons > threshold, gallons - threshold).otherwise(F.lit(0.0))
    return charge + over / 1000 * rate_per_1000


def block_bill_rounded(charge: Column, rate_per_1000: Column, threshold: Column, gallons: Column) -> Column:
    """The two-block bill in whole cents, as it is printed: exact in decimals, halves away from zero."""
    over = F.greatest(gallons - threshold, F.lit(0.0)).cast("decimal(18,3)")
    whole = charge.cast("decimal(18,4)") + over * rate_per_1000.cast("decimal(12,4)") / 1000
    return F.round(whole, 2).cast("double")


def utility_bill_parts(gallons: Column, water: dict[str, Column], sewer: dict[str, Column], storm: dict[str, Column],
                       years: dict[str, Column]) -> Column:
    """What a bill is made of: per service its amount now, its amount before and the difference, and the years of the rates.

    A service without both rate sets is null; stormwater is a twelfth of its year.
    """
    def part(name: str, now: Column, was: Column) -> Column:
        return F.struct(now.alias("now"), was.alias("was"), (now - was).alias("delta")).alias(name)

    def metered(rates: dict[str, Column], when: str) -> Column:
        return block_bill(rates[f"charge_{when}"], rates[f"rate_{when}"], rates["threshold"], gallons)

    return F.struct(part("water", metered(water, "now"), metered(water, "was")), part("sewer", metered(sewer, "now"), metered(sewer, "was")),
                    part("stormwater", storm["now"] / 12, storm["was"] / 12), years["now"].alias("rate_year"), years["was"].alias("previous_year"))


def utility_bill(gallons: Column, water: dict[str, Column], sewer: dict[str, Column],
                 storm: dict[str, Column], increase: dict[str, Column]) -> Column:
    """The monthly bill from the rate sets, else the published increase at the nearest level.

    `water`/`sewer` carry charge_now, rate_now, charge_was, rate_was, threshold;
    `storm` carries now and was, per year; `increase` carries water_min, water_avg,
    sewer_min, sewer_avg.  The parts actually added are listed in `components`.
    """
    zero = F.lit(0.0)
    exact = water["charge_now"].isNotNull() & sewer["charge_now"].isNotNull()

    def bill(rates, when):
        return block_bill(rates[f"charge_{when}"], rates[f"rate_{when}"], rates["threshold"], gallons)

    storm_now = F.coalesce(storm["now"], zero) / 12
    storm_was = F.coalesce(storm["was"], zero) / 12
    now = bill(water, "now") + bill(sewer, "now") + storm_now
    was = bill(water, "was") + bill(sewer, "was") + storm_was

    (_, low), (_, high) = LEVELS
    at_min = F.abs(gallons - low) < F.abs(gallons - high)
    more_water = F.when(at_min, increase["water_min"]).otherwise(increase["water_avg"])
    more_sewer = F.when(at_min, increase["sewer_min"]).otherwise(increase["sewer_avg"])
    known = more_water.isNotNull() | more_sewer.isNotNull()
    published = F.when(known, F.coalesce(more_water, zero) + F.coalesce(more_sewer, zero))
    parts = F.array_compact(F.array(F.when(more_water.isNotNull(), F.lit("water")),
                                    F.when(more_sewer.isNotNull(), F.lit("sewer"))))
    return F.struct(
        exact.alias("exact"),
        F.when(exact, gallons).when(at_min, F.lit(float(low))).otherwise(F.lit(float(high)))
        .alias("gallons"),
        F.when(exact, now).alias("bill"), F.when(exact, now * 12).alias("annual"),
        F.when(exact, now - was).otherwise(published).alias("increase"),
        F.when(exact, F.array(F.lit("water"), F.lit("sewer"), F.lit("stormwater")))
        .otherwise(parts).alias("components"),
        (exact | known).alias("known"))


def component_phrase(components: Column) -> Column:
    """`water, sewer and the stormwater fee`, from what the total really holds."""
    names = F.transform(components, lambda c: F.when(c == "stormwater", "the stormwater fee")
                        .otherwise(c))
    n = F.size(names)
    # try_element_at: the branches below are all evaluated, also on short lists.
    last = F.try_element_at(names, F.lit(-1))
    head = F.array_join(F.slice(names, 1, F.greatest(n - 1, F.lit(0))), ", ")
    return F.when(n <= 0, "").when(n == 1, last).otherwise(F.concat(head, F.lit(" and "), last))


def resident_total(tax: Column, utility: Column) -> Column:
    """Tax and utility figures side by side in one struct, without a common sum."""
    return F.struct(tax["total"].alias("tax_annual"), tax["monthly"].alias("tax_monthly"),
                    tax["complete"].alias("complete"),
                    utility["bill"].alias("utility_monthly"),
                    (utility["bill"] * 12).alias("utility_annual"),
                    utility["increase"].alias("increase_monthly"),
                    (utility["increase"] * 12).alias("increase_annual"))
