"""Work that is done once: figures of a line are read once, and lines meet no copy of themselves in a join."""

import pytest
from pyspark.sql import functions as F

from footings.plans import lineitems, statements


class Seen(Exception):
    pass


def optimized(monkeypatch, module, run):
    """The optimized plan of the first table that `run` stores."""
    def stop(df):
        raise Seen(df._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(module, "stored", stop)
    with pytest.raises(Seen) as seen:
        run()
    return str(seen.value)


def test_flat_lines_are_read_once(spark, monkeypatch):
    pages = spark.range(3).select(F.lit(1).alias("doc_id"), F.col("id").alias("page_no"), F.lit("Budget and Actual\nGeneral Fund").alias("text"))
    plan = optimized(monkeypatch, statements, lambda: statements.flat_statements(pages))
    assert "Join" not in plan
    assert plan.count("Repartition") == 1 and plan.count(statements.FLAT_FIGURES) == 1


SUMMARY = """Financial Summary: General Fund
Personnel $1 $2
FY25 Actual FY26 Estimate
Personnel $3 $4
Expenditures by Type
Personnel $5 ($6) 17
Water $7 $8
FY25 Actual FY26 Estimate FY27 Budget
Capital $9 –
Operating $10 $11 $12
Revenues by Type
Transfers $1 $2 $3
Expenditures by Type

Transfers – ($14) $15"""


def test_summary_pages_are_read_inside_their_rows(spark):
    pages = spark.createDataFrame([(1, 1, SUMMARY.replace("$5", "$99")), (1, 2, SUMMARY), (2, 1, "Financial Summary: Other"), (3, 1, None)], "doc_id int, page_no int, text string")
    found = lineitems.published_totals(pages, {"general fund": "General Fund"})
    got = sorted(tuple(r)[2:] for r in found.collect())
    assert got == [("Operating", 2025, "actual", 10.0), ("Operating", 2026, "estimate", 11.0), ("Operating", 2027, "budget", 12.0),
                   ("Personnel", 2025, "actual", 5.0), ("Personnel", 2026, "estimate", -6.0),
                   ("Transfers", 2026, "estimate", -14.0), ("Transfers", 2027, "budget", 15.0)]
    # One window is left, that of the last page; no line is sorted.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


def test_orders_are_spread_before_their_lines(spark, tmp_path):
    from footings.queries import load_all
    from footings.queries.registry import REGISTRY, Tables

    load_all()

    spark.createDataFrame([(k, k % 3, "LOW", 5.0) for k in range(2000)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_totalprice double") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    rows = REGISTRY["w12_wrap_labels"][0](Tables(spark, str(tmp_path)))
    assert rows.count() == 4000
    assert "RepartitionByExpression" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_a_page_meet_no_join(spark, monkeypatch):
    words = spark.createDataFrame([(1, 1, "x", 1.0, 2.0, 3.0, 4.0)], "doc_id int, page_no int, text string, x0 double, x1 double, top double, bottom double")
    plan = optimized(monkeypatch, statements, lambda: statements.statement_rows(words))
    assert "Join" not in plan and "Window" not in plan and plan.count("Repartition") == 1


def test_rows_and_rejected_figures(spark):
    """Touching marks are one figure; the second figure at a column, and one far from all, are problems."""
    words = []
    for i in range(4):
        top = 60.0 + 12 * i
        for text, x0, x1 in (("Part", 40, 60), ("no-", 66, 90), ("$", 240, 244), ("1", 280, 283), (f"0{i}", 285, 300), ("(7)", 385, 400)):
            words.append((1, 1, text, float(x0), float(x1), top, top + 8))
    words += [(1, 1, "55", 306.0, 307.0, 96.0, 104.0), (1, 1, "99", 480.0, 490.0, 96.0, 104.0), (1, 2, "alone", 1.0, 2.0, 60.0, 68.0)]
    rows, problems = statements.statement_rows(spark.createDataFrame(words, "doc_id int, page_no int, text string, x0 double, x1 double, top double, bottom double"))
    got = sorted((r["page_no"], r["label"], r["indent"], r["values"], r["has_figures"]) for r in rows.collect())
    assert got == [(1, "Part no-", 40.0, [100.0 + i, -7.0], True) for i in range(4)]
    assert sorted(r["text"] for r in problems.collect()) == ["55", "99"]


def test_a_stored_table_is_not_taken_for_small(spark):
    """Printed lines pack to a small part of their size: a table of 40 MB must not be broadcast for its file of 1 MB."""
    from footings.session import stored

    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.sources.fileCompressionFactor")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        lines = stored(spark.range(400_000).select("id", F.concat(F.lit("A justification form that could be funded by fees, number "), "id").alias("text")))
        joined = spark.range(10**9).join(lines, "id")
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        few = stored(spark.range(10).select("id", F.lit("x").alias("text")))
        assert "Broadcast" in spark.range(10**9).join(few, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_shuffles_of_an_earlier_step_are_freed(spark):
    import time

    from footings.session import stored

    def written():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = written()
    step = stored(spark.range(100_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.sum("id").alias("s")))
    own = written() - before
    time.sleep(1)
    stored(spark.range(10))
    deadline = time.time() + 20
    while written() & own and time.time() < deadline:
        time.sleep(0.2)
    assert not written() & own
    assert step.count() == 5000


def test_a_roll_forward_moves_its_own_lines_only(spark):
    from footings.operators import proof

    lines = [(1, 1, "Total revenues", [10.0, None]), (1, 2, "Total expenditures", [4.0, None]), (1, 3, "Excess of revenues", [6.0, None]),
             (1, 4, "Excess of revenues", [7.0, None]), (2, 1, "Total revenues", [None, None]), (2, 2, None, [1.0, 2.0]), (2, 3, "Total revenues", None)]
    lines += [(p, 9, f"Line {p}", [1.0, 2.0]) for p in range(1, 400)]
    rows = spark.createDataFrame(lines, "page int, n int, label string, v array<double>")

    def moved(plan):
        own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
        children = plan.children()
        return own + sum(moved(children.apply(i)) for i in range(children.size()))

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        proved = proof.prove_rollforward(rows, ["page"], "n", "label", "v")
        got = [(r["page"], r["column_index"], r["line"], r["value"], r["expected"]) for r in proved.collect()]
        assert got == [(1, 0, "Excess of revenues", 6.0, 6.0)]
        assert 0 < moved(proved._jdf.queryExecution().executedPlan()) <= 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_a_publication_builds_its_facts_once(spark, tmp_path, monkeypatch):
    from footings.queries import warehouse

    built = []
    facts, _ = warehouse.warehouse.financial_facts([spark.range(20).select(
        F.lit("ORG_HB").alias("Organization_ID"), (F.col("id") % 3 + 2000).cast("int").alias("Fiscal_Year"), F.lit("Actual").alias("Scenario"), F.lit("F").alias("Fund_ID"),
        F.lit("Expenditure").alias("Flow"), F.lit("D").alias("Department"), F.lit("A").alias("Account"), F.lit("C").alias("Category"), F.lit("amount").alias("Measure"),
        F.lit(1.0).alias("Amount"), F.lit("DOC").alias("Source_ID"), F.lit("x").alias("Source_Detail"), F.lit(1).alias("Source_Page"), F.lit("High").alias("Confidence"),
        F.lit("digital-text").alias("Extraction"), F.lit(True).alias("repeatable"), F.col("id").alias("printed"))],
        spark.createDataFrame([("DOC",)], "id string"), spark.createDataFrame([(2001, "REP")], "year int, document string"),
        spark.createDataFrame([("OTHER", 2001)], "Organization_ID string, Fiscal_Year int"))
    seen = spark.sparkContext.accumulator(0)
    counted = facts.mapInArrow(lambda batches: (seen.add(b.num_rows) or b for b in batches), facts.schema)
    monkeypatch.setattr(warehouse, "build", lambda t: built.append(1) or (counted, None))
    found = warehouse.s08_publish(warehouse.query.__globals__["Tables"](spark, str(tmp_path)))
    assert [tuple(r) for r in found.collect()] == [(1, 3, 20, 20), (2, 0, 0, 20), (3, 1, 7, 14)]
    assert built == [1] and seen.value == 20
