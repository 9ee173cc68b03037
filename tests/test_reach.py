"""Structural ends instead of fixed reaches, and answers off the usual path."""

import pytest
from pyspark.sql import functions as F

from footings.functions.text import tokens
from footings.operators import gates, joins, windows
from footings.plans import projects, prose, rates
from footings.sources import cells


def pages(spark, *texts):
    return spark.createDataFrame([(1, k + 1, t) for k, t in enumerate(texts)], "doc_id int, page_no int, text string")


def test_prose_runs_to_the_next_heading(spark):
    said = [f"sentence {k}" for k in range(20)]
    lines = spark.createDataFrame([(1, k, t) for k, t in enumerate(["Why", *said, "How", "x"])], "f int, n int, line string")
    got = {r["section"]: r["prose"] for r in windows.section_prose(lines, ["f"], ["n"], "line", {"why": "^Why$", "how": "^How$"}).collect()}
    assert got == {"why": " ".join(said), "how": "x"}


BANNER = "Pump\nCapital Improvement Project (FY27 - FY33)\nnote\nnote\nnote\nnote\nnote\nnote\nnote\nFund Department Priority Rank\nWater Fund Works 3\n"


def test_a_project_spans_any_number_of_pages(spark):
    filler = "Project Highlights\nmore"
    first = BANNER + "Project Description\nText."
    last = "Operating Budget Impact\nObject Code Description FY27\nDEBT SERVICE - BONDS $5\nAMOUNT $5"
    got = projects.project_pages(pages(spark, first, filler, "a", "b", "c", last, "Project Expenditures\nNOT OURS $5"))
    assert [r["page_no"] for r in got.orderBy("page_no").collect()] == [1, 2, 3, 4, 5, 6]
    found, _, _ = projects.project_register(pages(spark, first, filler, "a", "b", last))
    row = found.first()
    assert (row["fund"], row["department"], row["priority_rank"]) == ("Water Fund", "Works", 3)


def test_a_heading_without_its_table_is_not_published(spark):
    table = "Project Expenditures\nItemization Description FY27\nPIPES $5\nAMOUNT $5\n"
    end = "Operating Budget Impact\nObject Code Description FY27\nINSURANCE $0\nAMOUNT $0"
    whole, _, _ = projects.project_register(pages(spark, BANNER + table + end))
    empty, _, _ = projects.project_register(pages(spark, BANNER + table + "Project Funding\n" + end))
    assert (whole.first()["published"], empty.first()["published"]) == (True, False)


def test_labels_that_share_their_beginning_stay_apart(spark):
    years = "2016 2017 2018 2019"
    text = f"Overlapping Rates\n{years}\nRiverside county $0.10 $0.11 $0.12 $0.13\nRiverside town $0.20 $0.21 $0.22 $0.23\nRivers $0.30 $0.31 $0.32 $0.33"
    got = rates.rate_tables(pages(spark, text), "Overlapping Rates", [("county", "Riverside county"), ("town", "Riverside town")])
    assert {(r["entity"], r["year"]): r["rate"] for r in got.collect() if r["year"] == 2016} == {("county", 2016): 0.10, ("town", 2016): 0.20}


def test_bill_increases_far_from_their_location(spark):
    text = ("Rate Impact 5,000 gallons per month 2,000 gallons per month In-Town Rates " + "x " * 300 + "Water $3.10 $1.20 Sewer $2.00 $1.00 "
            "Out-of-Town Rates Water $6.10 $2.20")
    got = {(r["location"], r["service"], r["level"]): r["value"] for r in prose.rate_impact(pages(spark, text)).collect()}
    assert got == {("intown", "water", "avg"): 3.1, ("intown", "water", "min"): 1.2, ("intown", "sewer", "avg"): 2.0,
                   ("intown", "sewer", "min"): 1.0, ("outoftown", "water", "avg"): 6.1, ("outoftown", "water", "min"): 2.2}


def test_grid_header_far_below_its_title(spark):
    text = "Projected Surplus/(Deficit)\n" + "\n".join(f"line {k}" for k in range(12)) + "\nFY26 FY27 FY28 FY29 FY30 FY31 FY32\n" + \
        "\n".join("x" for _ in range(7)) + "\nRevenue 1 2 3 4 5 6 7"
    got = prose.projection_grid(pages(spark, text), [("Revenue", "revenue", "usd")]).collect()
    assert [(r["fiscal_year"], r["value"], r["basis"]) for r in got] == [(2026 + k, 1.0 + k, "reported") for k in range(7)]


def test_columns_with_one_heading(spark):
    rows = [("Id", "FY26", "Note", "Note"), ("7", "5", "first", "last")]
    df = spark.createDataFrame([("s", r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row)], "sheet string, row int, col int, value string")
    got = cells.records_with_overflow(df, ["sheet"], ["Id", "FY26"], "Id").first()
    assert (got["Id"], got["FY26"], got["other_fields"]) == ("7", "5", {"Note": "last"})


def test_amounts_no_sum_can_hold(spark):
    df = spark.createDataFrame([(1, 1e20), (2, float("nan")), (3, 2.5), (4, None)], "k int, v double")
    assert df.agg(F.sum(joins.money("v"))).first()[0] == 2.5
    assert sorted(r["k"] for r in joins.unreadable_money(df, ["k"], "v").collect()) == [1, 2]


def test_rows_without_checkable_figures_stay(spark):
    rows = spark.createDataFrame([(1, 2024, 5000.0, 3.0), (2, 2024, 3.0, None), (3, 2024, None, None)], "k int, y int, a double, b double")
    known = spark.createDataFrame([(2024, -5000.0), (2024, 3.0)], "y int, v double")
    got = joins.corroborate_values(rows, known, ["k"], "y", ["a", "b"], "v", floor=1000.0)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 1), (2, 0, 0), (3, 0, 0)]
    every = joins.corroborate_values(rows, known, ["k"], "y", ["a", "b"], "v")
    assert sorted(tuple(r) for r in every.collect()) == [(1, 2, 2), (2, 1, 1), (3, 0, 0)]


def test_directions_joined_by_a_slash(one):
    words = one(lambda c: F.array_join(F.array_sort(tokens(c, projects.REQUEST_ABBREVIATIONS, projects.REQUEST_STOP)), " "), "N/S Main St.")
    assert "north" in words and "south" in words


def test_a_failing_gate_says_how_many(spark):
    bad = spark.range(50).select(F.lit("g").alias("gate"), F.col("id").cast("string").alias("where"), F.lit("p").alias("problem"))
    with pytest.raises(gates.GateFailed, match="50 violations"):
        gates.gate(bad)


def test_shared_folder_is_required_off_local_masters(spark, monkeypatch):
    from footings import session

    class Context:
        master = "spark://somewhere"

        def getConf(self):
            return self

        def get(self, *_):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_a_mention_of_the_last_section_ends_no_project(spark):
    from footings.plans.projects import project_checks, project_fields, project_register

    banner = "Reservoir\nCapital Improvement Project (FY27 - FY33)\nFund Department Priority Rank\nWater Fund  Utilities  3"
    pages = spark.createDataFrame([
        (1, 1, banner + "\nProject Description\nSee Operating Budget Impact below."), (1, 2, "A drawing"),
        (1, 3, "Project Expenditures\nItemization Description FY27\nLAND $1,500\nWORKS $500\nAMOUNT $2,500"),
        (1, 4, "Operating Budget Impact\nUpkeep will rise."), (1, 5, "Appendix\nProject Funding\nOTHER $5\nAMOUNT $9")],
        "doc_id int, page_no int, text string")
    projects, rows, _ = project_register(pages)
    assert [(r["title"], r["published"]) for r in projects.collect()] == [("Reservoir", False)] and rows.count() == 2
    assert [(r["table"], r["sum_of_lines"], r["printed_total"], r["reconciles"]) for r in project_checks(pages).collect()] == [("expenditures", 2000.0, 2500.0, False)]
    field = project_fields(pages).first()
    assert field["source_pages"] == [1, 2, 3, 4] and field["operating_budget_impact"] == "Upkeep will rise." and field["has_stated_budget_impact"]


def test_long_labels_and_unread_figures(spark):
    from footings.plans.statements import flat_statements

    head = "Budget and Actual  General Fund\nRevenues:\nTaxes collected   1,000   1,000\n"
    long = "Intergovernmental revenues that are restricted by grant agreement or by statute   500   500\n"
    pages = [(1, 1, head + long + "Total revenues   1,500   1,500"), (2, 1, head + long + "Total revenues   1,000   1,000"),
             (3, 1, head + "Other *   500\nTotal revenues   1,000   1,000"), (4, 1, head + "Total revenues   1,000   1,000")]
    totals, _ = flat_statements(spark.createDataFrame(pages, "doc_id int, page_no int, text string"))
    assert {r["doc_id"] for r in totals.collect()} == {1, 4}
