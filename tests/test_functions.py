"""Meanings that SQL cannot show: blank is not zero, tolerance edges, ties."""

import pytest
from pyspark.sql import functions as F

from footings.functions import checks, money, text, years
from footings.functions import household as hh


@pytest.mark.parametrize("printed, value", [
    ("$1,234,567", 1234567.0), ("(1,234)", -1234.0), ("51.3", 51.3), ("73%", 73.0), ("TBD", None), ("-", None),
    ("", None), ("n/a", None), ("12x", None), ("(5)%", 5.0), ("  $ 7 ", 7.0)])
def test_parse_money(one, printed, value):
    assert one(money.parse_money, printed) == value


@pytest.mark.parametrize("printed, value", [("–", None), ("—", None), ("($1,234)", -1234.0), ("$5", 5.0), ("$(7)", -7.0)])
def test_table_cell_blank_is_not_zero(one, printed, value):
    assert one(money.parse_money_table, printed) == value


@pytest.mark.parametrize("printed, value", [("(3.5)%", -3.5), ("(3.5%)", -3.5), ("$1,200", 1200.0), ("--", None)])
def test_prose_number(one, printed, value):
    assert one(money.parse_number_prose, printed) == value


@pytest.mark.parametrize("printed, value, noted", [
    ("$791k", 791000.0, False), ("$2.916M", 2916000.0, False), ("$1,124M", 1124000.0, True), ("soon", None, False)])
def test_suffix_money(one, printed, value, noted):
    got = one(money.suffix_money, printed)
    assert got["value"] == pytest.approx(value) if value else got["value"] is None
    assert (got["note"] is not None) == noted


def test_recognised_numbers(one):
    assert one(money.parse_ocr_number, "8,940 238") == 8940238.0
    assert one(money.ocr_numbers, "10,079,224 760,114") == [10079224.0, 760114.0]
    assert one(money.ocr_numbers, "(1 204)  3,000") == [-1204.0, 3000.0]
    assert one(money.clean_number, "1 0,474,657") == 10474657.0
    assert one(lambda c: money.clean_number(c, strict=True), "10,47") is None


@pytest.mark.parametrize("printed, year", [
    ("Year Ended June 30, 2027", 2027), ("FY27", 2027), ("FY2027", 2027), ("fiscal year 2026", 2026), ("2027", None)])
def test_fiscal_year(one, printed, year):
    assert one(years.fiscal_year, printed) == year


@pytest.mark.parametrize("name, year", [
    ("CAFR_Issued_FY2019.pdf", 2019), ("Audit 2019.pdf", 2019), ("minutes 2019.pdf", None), ("x_FY_19_y.pdf", 2019)])
def test_report_year(one, name, year):
    assert one(years.report_year, name) == year


@pytest.mark.parametrize("label, doubled", [
    ("FFYY22002277 OOppeerraattiinngg", True), ("SUPPLIES TOTAL", False), ("AABB", False), ("AABBCCDE", True), ("AABBCDEF", False)])
def test_looks_doubled(one, label, doubled):
    assert one(text.looks_doubled, label) == doubled


def test_keys(one):
    assert one(text.slug, "FY27 Budget & Plan.PDF") == "fy27-budget-plan"
    assert one(text.norm_header, " Fiscal Year (ID) ") == "Fiscal_Year_ID"
    assert one(text.strip_footer, "SALARIES $36,110 $41,000 249") == "SALARIES $36,110 $41,000"
    assert one(text.strip_footer, "TRANSFER TO FUND 69") == "TRANSFER TO FUND 69"


def test_tax_on_value(one):
    assert one(hh.tax_on_value, 500000.0, 51.3) == pytest.approx(2565)
    assert one(hh.tax_on_value, 500000.0, 67.58) == pytest.approx(3379)
    assert one(hh.tax_on_value, None, 51.3, kinds=["double", "double"]) is None


def test_property_tax_bill(one):
    def bill(value, where, town, county):
        return one(lambda v, w, t, c: hh.property_tax_bill(v, w, t, c), value, where, town, county,
                   kinds=["double", "string", "double", "double"])

    inside = bill(500000.0, "intown", 51.3, 67.58)
    assert inside["total"] == 5944.0 and inside["complete"]
    outside = bill(500000.0, "outoftown", None, 67.58)
    assert outside["total"] == 3379.0 and outside["complete"] and not outside["town"]["applies"]
    unknown = bill(500000.0, "intown", 51.3, None)
    assert unknown["total"] is None and not unknown["complete"]


def test_half_up_and_clamp(one):
    assert one(hh.half_up, -2.5) == -2.0
    assert one(hh.half_up, 2.5) == 3.0
    assert one(lambda v: hh.clamp(v, "home"), 5.0) == 1000.0
    assert one(lambda v: hh.clamp(v, "home"), None, kinds=["double"]) is None


def test_component_phrase(one):
    def phrase(*names):
        return one(lambda: hh.component_phrase(F.array(*[F.lit(n) for n in names]).cast("array<string>")))

    assert phrase() == "" and phrase("water") == "water"
    assert phrase("water", "sewer", "stormwater") == "water, sewer and the stormwater fee"


def test_checks(one):
    assert one(checks.cents_equivalent, 10.0, 0.0) is None
    over = one(checks.budget_variance, 100.0, 101.4)
    assert over["direction"] == "over" and over["pct"] == pytest.approx(1.4)
    assert one(checks.budget_variance, 0.0, 1.0) is None
    assert one(checks.spread_pct, 0.0, 5.0) is None
