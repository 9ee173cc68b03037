"""Readers over real files, and the statement job on a small sloping page."""

import json

from pyspark.sql import functions as F

from footings.plans import statements
from footings.sources import datasets, files, words


def test_read_dataset(spark, tmp_path):
    path = tmp_path / "facts.json"
    path.write_text(json.dumps({"note": "n", "facts": [{"metric": "m", "value": 1.5, "other": 1}, {"metric": "n", "value": None}]}, indent=2))
    got = datasets.read_dataset(spark, str(path), "metric string, value double", "facts").collect()
    assert [(r["metric"], r["value"]) for r in got] == [("m", 1.5), ("n", None)]


def test_inventory_rejects_empty_files(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "empty.pdf").write_bytes(b"")
    good, bad = files.inventory(spark, str(tmp_path))
    assert [(r["extension"], r["bytes"]) for r in good.collect()] == [("pdf", 1)]
    assert bad.count() == 1


def test_read_word_boxes(spark, tmp_path):
    (tmp_path / "w.tsv").write_text('text\tleft\ttop\twidth\theight\tconf\nTo"tal\t300\t600\t150\t30\t96.5\nnoise\t1\t1\t1\t1\t12\n \t1\t1\t1\t1\t90\nbad\tx\t1\t1\t1\t90\n')
    got = words.read_word_boxes(spark, str(tmp_path / "w.tsv"), []).collect()
    assert [tuple(r) for r in got] == [('To"tal', 72.0, 108.0, 144.0, 151.2, 96.5)]


def test_newest_version_ties(spark):
    held = spark.createDataFrame([("s", "a v2.1"), ("s", "b v2.1"), ("s", "c v1.9")], "stem string, name string")
    assert files.newest_version(held, "stem", "name").first()["name"] == "b v2.1"
    assert files.newest_version(held, "stem", "name", last_on_tie=False).first()["name"] == "a v2.1"


def test_scanned_page_to_proven_lines(spark):
    printed = [("REVENUES:", None), ("Taxes", (100, 110)), ("Fees", (20, 30)), ("Grants", (7, 8)), ("Total revenues", (127, 148))]
    boxes = []
    for i, (label, values) in enumerate(printed):
        for j, word in enumerate(label.split()):
            boxes.append((word, 40.0 + 40 * j, 70.0 + 40 * j, i))
        for j, value in enumerate(values or ()):
            right = 300.0 + 100 * j
            boxes.append((str(value), right - 5 * len(str(value)), right, i))
    sloped = [("d", 1, t, x0, x1, 60 + 12.0 * i + 0.01 * (x0 + x1) / 2, 68 + 12.0 * i + 0.01 * (x0 + x1) / 2) for t, x0, x1, i in boxes]
    frame = spark.createDataFrame(sloped, "doc_id string, page_no int, text string, x0 double, x1 double, top double, bottom double")
    rows, problems = statements.statement_rows(frame, scanned=True)
    assert {r["label"]: r["values"] for r in rows.collect()}["Total revenues"] == [127.0, 148.0]
    assert problems.count() == 0
    meta = spark.createDataFrame([("d", 1, "Exhibit 5", 2025)], "doc_id string, page_no int, statement_key string, fiscal_year int")
    lines = statements.verified_lines(rows, meta)
    assert sorted(r["line"] for r in lines.collect()) == ["Fees", "Grants", "Taxes", "Total revenues"]


def test_statement_titles(spark):
    pages = spark.createDataFrame([
        ("d", 1, "City\nSchedule 1\nfor the Year Ended June 30, 2024"), ("d", 2, "Statement of Cash Flows\nExhibit  7"),
        ("d", 3, "Notes to the Financial Statements\nSchedule of x"), ("d", 4, "Prose")], "doc_id string, page_no int, text string")
    got = {r["page_no"]: (r["statement_key"], r["fiscal_year"]) for r in statements.statement_pages(pages).collect()}
    assert got == {1: ("Schedule 1", 2024), 2: ("Exhibit 7", 2024)}


def test_digest_ignores_order(spark):
    a = spark.range(50).select(F.sha2(F.col("id").cast("string"), 256).alias("sha"))
    first = datasets.dataset_digest(a, "sha").first()
    assert first == datasets.dataset_digest(a.orderBy(F.col("sha").desc()), "sha").first() and first["members"] == 50
