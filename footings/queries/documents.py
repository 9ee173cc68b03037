"""Round trips: table rows are printed as document pages or word boxes, then read back.

Every oracle reads the rows the pages were printed from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.plans import lineitems, prose, tables
from footings.queries.registry import query

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
FUNDS = {"general fund": "General Fund"}
PER_DOC = 1000


def text_of(*lines):
    return F.concat_ws("\n", *lines)


def whole(c):
    return F.format_number(F.floor(c), 0)


def joined(rows, keys, order, line, out="body"):
    """The printed lines of one small group (an order has a handful of lines), in order."""
    packed = F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("o"), line.alias("t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(packed, lambda x: x["t"]), "\n").alias(out))


def appendix(t):
    """Two pages per order: its headings, then its rows; state must cross the page break."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    who = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey").join(who, "o_orderkey")
    name = F.concat(F.lit("PART-"), "l_partkey", F.lit(" SUPPLIER-"), "l_suppkey")
    # Hundreds keep a line of bare figures too short to look printed twice.
    figures = F.concat(F.lit("$"), whole(F.col("l_extendedprice") / 100), F.lit(" ($"), F.format_number("l_quantity", 0), F.lit(") –"))
    row = (F.when(c % 3 == 0, F.concat(name, F.lit("\n"), figures))
           .when(c % 3 == 1, F.concat(name, F.lit("\ncontinued below\n"), figures))
           .otherwise(F.concat_ws(" ", name, figures, F.when(F.col("l_linenumber") == 1, F.lit("17")))))
    body = joined(lines, ["o_orderkey"], LINE_ORDER, row)
    doc = F.floor(k / PER_DOC).alias("doc_id")
    first = (k % PER_DOC * 2 + 1).cast("int")
    heads = who.select(doc, first.alias("page_no"), text_of(
        F.when(k % 100 == 0, F.lit("Line-Item Budget: General Fund -")), F.concat(F.lit("Office-"), k),
        F.lit("FY25 Actual FY26 Estimate FY27 Budget"), F.lit("Expenses"), F.lit("Personnel"), F.lit("12")).alias("text"))
    rows = who.join(body, "o_orderkey").select(doc, (first + 1).alias("page_no"), text_of(
        F.lit("Operating & Capital Budget"), F.concat(F.lit("Office-"), k), F.lit("FY25 Actual FY26 Estimate FY27 Budget"),
        F.col("body"), F.when(c % 5 == 0, F.lit("BAD ROW $1 $2")), F.lit("PERSONNEL TOTAL $5 ($6) $7"),
        F.when(c % 7 == 0, F.lit("Debt Service $80 ($1) –"))).alias("text"))
    return heads.unionByName(rows)


NAMED = """
n AS (SELECT o_orderkey AS k, o_custkey AS c, 'Office-' || o_orderkey AS department, o_orderkey // 1000 AS doc_id, CAST(o_orderkey % 1000 * 2 + 2 AS INTEGER) AS page
      FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))"""


@query("d01_line_items", f"""
WITH {NAMED}, a AS (SELECT n.*, 'PART-' || l_partkey || ' SUPPLIER-' || l_suppkey || CASE WHEN c % 3 = 1 THEN ' continued below' ELSE '' END AS account, floor(l_extendedprice / 100)::DOUBLE AS p, -l_quantity AS q FROM lineitem JOIN n ON k = l_orderkey)
SELECT department, 'Personnel' AS category, account, 2025::INTEGER AS fiscal_year, 'actual' AS basis, p AS value, doc_id, page FROM a
UNION ALL SELECT department, 'Personnel', account, 2026, 'estimate', q, doc_id, page FROM a
UNION ALL SELECT department, 'Debt Service', 'Debt Service', 2025, 'actual', 80, doc_id, page FROM n WHERE c % 7 = 0
UNION ALL SELECT department, 'Debt Service', 'Debt Service', 2026, 'estimate', -1, doc_id, page FROM n WHERE c % 7 = 0""")
def d01(t):
    rows, _, _ = lineitems.line_items(appendix(t), FUNDS)
    return rows.filter("fund = 'General Fund'").drop("fund")


@query("d01_totals", f"""
WITH {NAMED} SELECT department, 'PERSONNEL TOTAL' AS account, CAST(2025 + i AS INTEGER) AS fiscal_year, CASE i WHEN 0 THEN 5 WHEN 1 THEN -6 ELSE 7 END::DOUBLE AS value FROM n, range(3) r(i)""")
def d01_totals(t):
    _, totals, _ = lineitems.line_items(appendix(t), FUNDS)
    return totals.select("department", "account", "fiscal_year", "value")


@query("d01_problems", f"""
WITH {NAMED} SELECT doc_id, page AS page_no, 'figures do not match the columns' AS problem FROM n WHERE c % 5 = 0""")
def d01_problems(t):
    _, _, problems = lineitems.line_items(appendix(t), FUNDS)
    return problems.select("doc_id", "page_no", "problem")


@query("d02_published_totals", """
WITH p AS (SELECT o_custkey AS doc_id, max(o_orderkey) AS k FROM orders GROUP BY 1), v AS (SELECT p.doc_id, o_totalprice AS t, o_custkey AS c FROM p JOIN orders ON o_orderkey = k)
SELECT doc_id, 'General Fund' AS fund, 'Personnel' AS category, CAST(2025 AS INTEGER) AS fiscal_year, 'actual' AS basis, floor(t)::DOUBLE AS value FROM v
UNION ALL SELECT doc_id, 'General Fund', 'Personnel', 2026, 'estimate', -(c + 1)::DOUBLE FROM v UNION ALL SELECT doc_id, 'General Fund', 'Capital', 2025, 'actual', 4 FROM v""")
def d02(t):
    """Customers are documents, their orders are summary pages; the last page wins."""
    pages = t.orders.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_no"), text_of(
        F.lit("Financial Summary:  General Fund - overview"), F.lit("FY25 Actual FY26 Estimate"), F.lit("Revenues by Type"),
        F.lit("Operating $9 $9"), F.lit("Expenditures by Type"),
        F.concat(F.lit("Personnel $"), whole("o_totalprice"), F.lit(" ($"), F.format_number(F.col("o_custkey") + 1, 0), F.lit(") 41")),
        F.lit("Water (projected) $1 $2"), F.lit("Capital $4 –"), F.lit("EXPENSES TOTAL $3 $3"), F.lit("Debt Service $1 $2 $3")).alias("text"))
    return lineitems.published_totals(pages, FUNDS)


GRID_METRICS = [(r"Surplus/\(Deficit\)\s*[‐-―\-]\s*\$\s*amount", "surplus", "USD"),
                (r"Fund Balance\s*[‐-―\-]\s*available cash", "cash", "USD")]


@query("d03_projection_grid", """
WITH o AS (SELECT o_orderkey AS doc_id, floor(o_totalprice)::DOUBLE AS a, -(o_custkey + 1)::DOUBLE AS b, o_custkey % 3 AS m FROM orders)
SELECT doc_id, CAST(2 AS INTEGER) AS page_no, 'surplus' AS metric, 'USD' AS unit, CAST(2025 AS INTEGER) AS fiscal_year, CASE WHEN m = 0 THEN 'reported' ELSE 'actual' END AS basis, a AS value FROM o
UNION ALL SELECT doc_id, 2, 'surplus', 'USD', 2026, CASE WHEN m = 0 THEN 'reported' ELSE 'estimate' END, b FROM o
UNION ALL SELECT doc_id, 2, 'surplus', 'USD', 2027, CASE WHEN m = 0 THEN 'reported' ELSE 'projected' END, 3.5 FROM o
UNION ALL SELECT doc_id, 2, 'cash', 'USD', CAST(2025 + i AS INTEGER), CASE WHEN m = 0 THEN 'reported' WHEN i = 0 THEN 'actual' WHEN i = 1 THEN 'estimate' ELSE 'projected' END, i + 1 FROM o, range(3) r(i) WHERE m <> 1""")
def d03(t):
    return prose.projection_grid(grid_pages(t), GRID_METRICS)


@query("d03_grid_problems", """
SELECT o_orderkey AS doc_id, CAST(2 AS INTEGER) AS page_no, 'cash' AS metric, CAST(3 AS INTEGER) AS years, '1.0,2.0' AS figures FROM orders WHERE o_custkey % 3 = 1""")
def d03_problems(t):
    """A printed row with fewer figures than years is no fact, and is reported."""
    found = prose.grid_problems(grid_pages(t), GRID_METRICS)
    return found.withColumn("figures", F.array_join(F.col("figures").cast("array<string>"), ","))


def grid_pages(t):
    """Each order's message: a page, a grid with one row too short for some customers, and a title without a grid."""
    m = F.col("o_custkey") % 3
    grid = text_of(F.lit("FY20 FY21 FY22 sales tax axis"), F.lit("Projected Surplus/(Deficit) of the fund"), F.lit(""), F.lit("FY25 FY26 FY2027"),
                   F.when(m != 0, F.lit("Actual Estimate Projection")),
                   F.concat(F.lit("Surplus/(Deficit) – $ amount $"), whole("o_totalprice"), F.lit(" ("), F.format_number(F.col("o_custkey") + 1, 0), F.lit(") 3.5%")),
                   F.when(m == 1, F.lit("Fund Balance - available cash 1 2")).otherwise(F.lit("Fund Balance - available cash 1 2 $3")))
    other = F.lit("Projected Surplus/(Deficit) named without a table")
    pages = t.orders.select(F.col("o_orderkey").alias("doc_id"), F.explode(F.array(
        F.struct(F.lit(1).alias("page_no"), F.lit("A message").alias("text")), F.struct(F.lit(2).alias("page_no"), grid.alias("text")),
        F.struct(F.lit(3).alias("page_no"), other.alias("text")))).alias("p")).select("doc_id", "p.page_no", "p.text")
    return pages


@query("d04_rate_impact", """
WITH o AS (SELECT o_orderkey AS doc_id, o_totalprice AS v, o_custkey % 4 AS m FROM orders)
SELECT doc_id, 'intown' AS location, 'water' AS service, CASE i WHEN 0 THEN 'avg' ELSE 'min' END AS level, CAST(CASE i WHEN 0 THEN 4000 ELSE 2000 END AS INTEGER) AS gallons, CASE i WHEN 0 THEN v ELSE 1.86 END AS value FROM o, range(2) r(i) WHERE m <> 3
UNION ALL SELECT doc_id, 'intown', 'sewer', CASE i WHEN 0 THEN 'avg' ELSE 'min' END, CASE i WHEN 0 THEN 4000 ELSE 2000 END, CASE i WHEN 0 THEN 5.24 ELSE 2.62 END FROM o, range(2) r(i) WHERE m <> 3
UNION ALL SELECT doc_id, 'outoftown', 'water', CASE i WHEN 0 THEN 'avg' ELSE 'min' END, CASE i WHEN 0 THEN 4000 ELSE 2000 END, CASE i WHEN 0 THEN 7.24 ELSE 3.62 END FROM o, range(2) r(i) WHERE m = 1""")
def d04(t):
    m = F.col("o_custkey") % 4
    text = text_of(F.lit("Household effects"), F.when(m != 3, F.lit("4,000 gallons per month 2,000 gallons per month")), F.lit("Rate Impact"),
                   F.lit("In-Town Rates"), F.concat(F.lit("Water $"), F.format_number("o_totalprice", 2), F.lit(" $1.86")),
                   F.lit("Sewer $5.24 $2.62"), F.lit("x" * 220), F.when(m == 1, F.lit("Out-of-Town Rates\nWater $7.24 $3.62")))
    pages = t.orders.select(F.col("o_orderkey").alias("doc_id"), F.lit(5).alias("page_no"), text.alias("text"))
    return prose.rate_impact(pages).drop("page_no")


def plan_lines(t):
    """Each order's plan table in two segments; the AMOUNT of some customers' last column is off."""
    c = F.col("o_custkey")
    who = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    name = F.concat_ws("/", F.lit("ACCOUNT"), "l_linenumber", "l_partkey", "l_suppkey", F.format_number("l_quantity", 0))
    first = F.concat(name, F.lit(" $"), whole("l_extendedprice"), F.lit(" $("), F.format_number("l_quantity", 0), F.lit(")"))
    wrapped = F.concat(name, F.lit("\n$"), whole("l_extendedprice"), F.lit(" $("), F.format_number("l_quantity", 0), F.lit(")\nFUND"))
    lines = t.lineitem.join(who, "l_orderkey")
    one = joined(lines, ["l_orderkey"], LINE_ORDER, F.when(c % 3 == 0, wrapped).otherwise(first), "one")
    two = joined(lines, ["l_orderkey"], LINE_ORDER, F.concat(name, F.when(c % 3 == 0, F.lit(" FUND")).otherwise(F.lit("")), F.lit(" $"), F.format_number("l_linenumber", 0)), "two")
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.floor("l_extendedprice")).alias("a"), F.sum("l_quantity").alias("b"), F.sum("l_linenumber").alias("d"))
    off = F.when(c % 4 == 1, 1).otherwise(0)
    return who.join(one, "l_orderkey").join(two, "l_orderkey").join(sums, "l_orderkey").select(F.col("l_orderkey").alias("orderkey"), "o_custkey", text_of(
        F.lit("Itemization Description Current Project Budget FY27"), F.lit("Amount"), F.col("one"),
        F.concat(F.lit("AMOUNT $"), F.format_number("a", 0), F.lit(" $("), F.format_number("b", 0), F.lit(")")),
        F.lit("Itemization Description FY28"), F.lit("33"), F.col("two"),
        F.concat(F.lit("AMOUNT $"), F.format_number(F.col("d") + off, 0))).alias("text"))


def table_lines(pages, keys, text="text"):
    from footings.sources.words import to_lines

    return to_lines(pages, keys, text)


@query("d05_plan_tables", """
WITH l AS (SELECT l.*, o_custkey AS c FROM lineitem l JOIN orders ON o_orderkey = l_orderkey)
SELECT l_orderkey AS orderkey, 'ACCOUNT/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey || '/' || CAST(l_quantity AS INTEGER) || CASE WHEN c % 3 = 0 THEN ' FUND' ELSE '' END AS label,
  floor(l_extendedprice)::DOUBLE AS a, -l_quantity AS b, l_linenumber::DOUBLE AS d, c % 4 <> 1 AS reconciles FROM l""")
def d05(t):
    rows, totals = tables.plan_tables(table_lines(plan_lines(t), ["orderkey"]), ["orderkey"])
    checks = tables.prove_tables(rows, totals, ["orderkey"])
    amounts = F.col("amounts")
    return rows.join(checks, "orderkey").select("orderkey", "label", amounts[0].alias("a"), amounts[1].alias("b"),
                                                amounts[2].alias("d"), "reconciles")


@query("d16_bullets_after", """
SELECT o_orderkey AS doc_id, CAST(i AS INTEGER) AS item_no, CASE i WHEN 0 THEN o_orderpriority WHEN 1 THEN repeat('y', 81) ELSE 'Clerk ' || o_custkey END AS item FROM orders, range(3) r(i)""")
def d16(t):
    text = text_of(F.lit("Services, including:"), F.lit(""), F.col("o_orderpriority"), F.lit("This is a sentence."), F.lit("y" * 81),
                   F.concat(F.lit("  Clerk "), "o_custkey"), F.lit("Together, they serve"), F.lit("Not a service"))
    pages = t.orders.select(F.col("o_orderkey").alias("doc_id"), F.lit(1).alias("page_no"), text.alias("text"))
    return prose.bullets_after(pages, "including:", ["Together,"]).select("doc_id", "item_no", "item")




def word_pages(t):
    """Each order as a statement page of word boxes: fixed columns, figures in fragments.

    Orders with one line have too few figures for a grid and drop out.
    """
    k = F.col("l_orderkey")
    order = F.sort_array(F.collect_list(F.struct(*LINE_ORDER)))
    pages = t.lineitem.groupBy("l_orderkey").agg(order.alias("ls"))
    lines = pages.select(F.floor(k / PER_DOC).alias("doc_id"), k.alias("page_no"), F.posexplode("ls").alias("i", "l")) \
        .select("doc_id", "page_no", (F.col("i") * 12 + 60).cast("double").alias("top"), "l.*")

    def box(text, x0, x1):
        return F.struct(text.alias("text"), x0.cast("double").alias("x0"), x1.cast("double").alias("x1"))

    price = whole("l_extendedprice")
    head, tail = F.substring(price, 1, 1), F.substring(price, 2, 20)
    start = F.lit(300) - F.length(price) * 5
    boxes = F.array(
        box(F.lit("Part"), F.lit(40), F.lit(60)), box(F.concat(F.lit("no-"), "l_partkey"), F.lit(66), F.lit(90)),
        box(F.concat(F.lit("vendor-"), "l_suppkey"), F.lit(96), F.lit(150)), box(F.lit("$"), F.lit(240), F.lit(244)),
        box(head, start, start + 3), box(tail, start + 5, F.lit(300)),
        box(F.concat(F.lit("("), F.format_number("l_quantity", 0), F.lit(")")), F.lit(380), F.lit(400)),
        box(F.when(F.col("l_linenumber") == 7, F.lit("–")).otherwise(F.col("l_linenumber").cast("string")), F.lit(495), F.lit(500)))
    return lines.select("doc_id", "page_no", "top", (F.col("top") + 8).alias("bottom"), F.inline(boxes))


@query("d10_statement_rows", """
WITH n AS (SELECT l_orderkey AS k, count(*) AS n, count(*) FILTER (l_linenumber <> 7) AS thirds FROM lineitem GROUP BY 1 HAVING count(*) >= 3)
SELECT k // 1000 AS doc_id, k AS page_no, 'Part no-' || l_partkey || ' vendor-' || l_suppkey AS label, floor(l_extendedprice)::DOUBLE AS a, -l_quantity AS b,
  CASE WHEN thirds >= 3 AND l_linenumber <> 7 THEN l_linenumber::DOUBLE END AS c FROM lineitem JOIN n ON k = l_orderkey""")
def d10(t):
    from footings.plans.statements import statement_rows

    rows, _ = statement_rows(word_pages(t))
    v = F.col("values")
    return rows.select("doc_id", "page_no", "label", F.get(v, F.lit(0)).alias("a"), F.get(v, F.lit(1)).alias("b"), F.get(v, F.lit(2)).alias("c"))


def printed_statements(t, slope=0.0):
    """Each order as word boxes of one page: a heading, a line per item, and a total that is misprinted for some customers."""
    from pyspark.sql import Window

    at = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    items = t.lineitem.select(F.col("l_orderkey").alias("page_no"), at.alias("i"), F.concat(F.lit("Item-"), "l_partkey").alias("one"),
                              F.concat(F.lit("from-"), "l_suppkey").alias("two"), (F.floor("l_extendedprice") + 100).alias("a"), (F.col("l_quantity") + 100).cast("bigint").alias("b"))
    sums = items.groupBy("page_no").agg((F.max("i") + 1).alias("i"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    wrong = t.orders.select(F.col("o_orderkey").alias("page_no"), F.when(F.col("o_custkey") % 6 == 0, 3).otherwise(0).alias("_off"))
    totals = sums.join(wrong, "page_no").select("page_no", "i", F.lit("Total").alias("one"), F.lit("revenues").alias("two"), (F.col("a") + F.col("_off")).alias("a"), "b")
    heads = sums.select("page_no", F.lit(0).alias("i"), F.lit("REVENUES:").alias("one"), F.lit(None).cast("string").alias("two"), F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b"))
    lines = items.unionByName(totals).unionByName(heads)

    def box(text, x0, x1):
        return F.when(text.isNotNull(), F.struct(text.alias("text"), x0.cast("double").alias("x0"), x1.cast("double").alias("x1")))

    def figure(v, right):
        text = F.format_number(v, 0)
        return box(text, F.lit(right) - F.length(text) * 5, F.lit(right))

    boxes = F.array_compact(F.array(box(F.col("one"), F.lit(40), F.lit(90)), box(F.col("two"), F.lit(95), F.lit(140)), figure(F.col("a"), 300), figure(F.col("b"), 400)))
    top = F.lit(60.0) + F.col("i") * 12 + (F.col("x0") + F.col("x1")) / 2 * slope
    return lines.select((F.col("page_no") / PER_DOC).cast("bigint").alias("doc_id"), "page_no", "i", F.inline(boxes)) \
        .select("doc_id", "page_no", "text", "x0", "x1", top.alias("top"), (top + 8).alias("bottom"))


def proven_lines(t, slope, scanned):
    from footings.plans.statements import statement_rows, verified_lines

    rows, _ = statement_rows(printed_statements(t, slope), scanned)
    meta = t.orders.select((F.col("o_orderkey") / PER_DOC).cast("bigint").alias("doc_id"), F.col("o_orderkey").alias("page_no"),
                           F.lit("Exhibit 5").alias("statement_key"), F.year("o_orderdate").alias("fiscal_year"))
    return verified_lines(rows, meta).select("page_no", "group", "line", F.get("values", F.lit(0)).alias("a"), F.get("values", F.lit(1)).alias("b"),
                                             "is_subtotal", "verified_by", "fiscal_year")


PROVEN = """
WITH i AS (SELECT l_orderkey AS k, 'Item-' || l_partkey || ' from-' || l_suppkey AS line, floor(l_extendedprice) + 100 AS a, l_quantity + 100 AS b FROM lineitem),
g AS (SELECT k, count(*) AS n, sum(a) AS a, sum(b) AS b, any_value(CAST(year(o_orderdate) AS INTEGER)) AS y FROM i JOIN orders ON o_orderkey = k WHERE o_custkey % 6 <> 0 GROUP BY 1 HAVING count(*) >= 2)
SELECT k AS page_no, 'REVENUES' AS "group", line, i.a::DOUBLE AS a, i.b::DOUBLE AS b, FALSE AS is_subtotal, 'components sum to the printed total, per column' AS verified_by, y AS fiscal_year FROM i JOIN g USING (k)
UNION ALL SELECT k, 'REVENUES', 'Total revenues', a::DOUBLE, b::DOUBLE, TRUE, 'printed total, reconciled against its components', y FROM g"""


@query("d10_words_to_proven_lines", PROVEN)
def d10_proven(t):
    """From word boxes of a digital page to the lines that its own total proves."""
    return proven_lines(t, 0.0, False)


@query("d10_scanned_words_to_proven_lines", PROVEN)
def d10_scanned(t):
    """The same statements, recognised on a sheet that lay askew."""
    return proven_lines(t, 0.01, True)


def nested_rows(t, wrong=None):
    """Each order as a nested statement: ASSETS over "Flag A:" with a total and "Flag R:" without.

    Lines with flag N fall under ASSETS directly.  `wrong` marks orders whose grand total
    is misprinted.
    """
    from pyspark.sql import Window

    v = F.array(F.col("l_extendedprice"), F.col("l_quantity"))
    rank = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    name = F.concat_ws(" ", F.lit("Line"), "l_linenumber", "l_partkey", "l_suppkey", F.format_number("l_quantity", 0))

    def printed(df, label, values, indent, group, seq):
        return df.select("l_orderkey", label.alias("label"), values.alias("values"), F.lit(indent).alias("indent"),
                         F.struct(group.alias("g"), seq.alias("s")).alias("at"))

    def sums(df):
        return df.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("a"),
                                            F.sum("l_quantity").alias("b"))

    zero, none = F.struct(*[F.lit(0).cast("long").alias(f"k{i}") for i in range(4)]), F.array(F.lit(None).cast("double"), F.lit(None).cast("double"))
    top = F.struct(*[F.lit(10**15).cast("long").alias(f"k{i}") for i in range(4)])
    seq = F.struct(*[F.col(c).cast("long").alias(f"k{i}") for i, c in enumerate(LINE_ORDER[:4])])
    pages = t.lineitem.select("l_orderkey").distinct()
    flagged = t.lineitem.filter("l_returnflag = 'A'")
    off = F.lit(0) if wrong is None else F.when(wrong, 3).otherwise(0)
    parts = [printed(pages, F.lit("ASSETS"), none, 10.0, F.lit(-1), zero),
             printed(flagged.select("l_orderkey").distinct(), F.lit("Flag A:"), none, 20.0, F.lit(1), zero),
             printed(t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey").distinct(), F.lit("Flag R:"), none, 20.0, F.lit(2), zero),
             printed(t.lineitem, name, v, 30.0, rank, seq),
             printed(sums(flagged), F.lit("Total flag a"), F.array("a", "b"), 30.0, F.lit(1), top),
             printed(sums(t.lineitem), F.lit("Total assets"), F.array(F.col("a") + off, F.col("b")), 30.0, F.lit(9), top)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    # Rows are numbered inside one printed page.
    w = Window.partitionBy("l_orderkey").orderBy("at")
    return rows.select(F.floor(F.col("l_orderkey") / PER_DOC).alias("doc_id"), F.col("l_orderkey").alias("page_no"),
                       F.row_number().over(w).alias("row_no"), "label", "indent", "values",
                       F.exists("values", lambda x: x.isNotNull()).alias("has_figures"))


NESTED = """
f AS (SELECT l_orderkey AS k, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag <> 'A') AS o, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS t,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'A') AS DOUBLE) AS ta, o_custkey AS c FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, o_custkey)"""


@query("d11_nested_groups", f"""
WITH {NESTED} SELECT k AS page_no, 'Flag A' AS "group", 'Total flag a' AS total_label, ta AS total, a AS lines, CAST(0 AS BIGINT) AS subtotals FROM f WHERE a > 0
UNION ALL SELECT k, 'ASSETS', 'Total assets', t, o + CASE WHEN a > 0 THEN 1 ELSE 0 END, CASE WHEN a > 0 THEN 1 ELSE 0 END FROM f""")
def d11(t):
    from footings.plans.statements import nested_groups

    parts = nested_groups(nested_rows(t))
    # Folded lines stay lines of their group: a coincidence of sums changes no count here.
    folded = F.col("part") == "folded"
    return parts.groupBy("page_no", "group_no", "group").agg(
        F.max(F.when(F.col("part") == "total", F.col("label"))).alias("total_label"),
        F.max(F.when(F.col("part") == "total", F.get("values", F.lit(0)))).alias("total"),
        F.count_if((F.col("part") == "line") | folded).alias("lines"),
        F.count_if((F.col("part") == "line") & F.col("is_subtotal")).alias("subtotals")).drop("group_no")


@query("d13_verified_lines", f"""
WITH {NESTED}
SELECT k AS page_no, 'Flag A' AS "group", 'Line ' || l_linenumber || ' ' || l_partkey || ' ' || l_suppkey || ' ' || CAST(l_quantity AS INTEGER) AS line, l_extendedprice AS amount FROM f JOIN lineitem ON l_orderkey = k WHERE l_returnflag = 'A'
UNION ALL SELECT k, 'Flag A', 'Total flag a', ta FROM f WHERE a > 0
UNION ALL SELECT k, 'ASSETS', 'Line ' || l_linenumber || ' ' || l_partkey || ' ' || l_suppkey || ' ' || CAST(l_quantity AS INTEGER), l_extendedprice FROM f JOIN lineitem ON l_orderkey = k WHERE l_returnflag <> 'A' AND c % 6 <> 0
UNION ALL SELECT k, 'ASSETS', 'Flag A / Total flag a', ta FROM f WHERE a > 0 AND c % 6 <> 0
UNION ALL SELECT k, 'ASSETS', 'Total assets', t FROM f WHERE c % 6 <> 0""")
def d13(t):
    """The lines of a misprinted grand total are withheld; its proven inner group is not."""
    from footings.plans.statements import verified_lines
    from footings.session import stored

    rows = nested_rows(t).join(t.orders.select(F.col("o_orderkey").alias("page_no"), "o_custkey"), "page_no")
    misprint = (F.col("label") == "Total assets") & (F.col("o_custkey") % 6 == 0)
    rows = rows.withColumn("values", F.when(misprint, F.transform("values", lambda x: x + 3)).otherwise(F.col("values"))).drop("o_custkey")
    # Printed once: the pages are read for groups, for roll-forwards and for their widths.
    rows = stored(rows)
    meta = t.orders.select(F.floor(F.col("o_orderkey") / PER_DOC).alias("doc_id"), F.col("o_orderkey").alias("page_no"),
                           F.concat(F.lit("Exhibit "), F.year("o_orderdate")).alias("statement_key"), F.year("o_orderdate").alias("fiscal_year"))
    return verified_lines(rows, meta).select("page_no", "group", "line", F.get("values", F.lit(0)).alias("amount"))


@query("d14_flat_statements", """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS d, floor(o_totalprice)::DOUBLE AS v, (1000 + o_custkey)::DOUBLE AS c, o_orderkey % 4 AS m FROM orders),
g AS (SELECT *, CASE WHEN m = 1 THEN 2 ELSE 4 END AS score FROM o),
b AS (SELECT d, arg_min(k, (-score, k)) AS k FROM g GROUP BY 1), s AS (SELECT g.* FROM g JOIN b USING (k))
SELECT d AS doc_id, k AS page_no, 'revenues' AS section, CAST(i AS INTEGER) AS column_index, CASE WHEN m <> 2 THEN CASE i WHEN 0 THEN 'original_budget' ELSE 'final_budget' END END AS column_role,
  CASE i WHEN 0 THEN v + c ELSE v + 2 * c END AS total, CAST(2 AS BIGINT) AS component_lines FROM s, range(2) r(i) WHERE i = 0 OR m <> 1""")
def d14(t):
    """Orders are recognised pages of their customer's report; some pages prove one column only."""
    v, c, m = F.floor("o_totalprice"), F.col("o_custkey") + 1000, F.col("o_orderkey") % 4

    def n(x):
        return F.format_number(x, 0)

    gap = F.lit("   ")
    text = text_of(
        F.lit("Budget and Actual  General Fund"), F.lit("Revenues:"),
        F.concat(F.lit("Ad valorem taxes"), gap, n(v), gap, F.regexp_replace(n(v), ",", " ")),
        F.concat(F.lit("Other  taxes "), gap, n(c), gap, n(c * 2)),
        F.concat(F.lit("Total revenues"), gap, n(v + c), gap, n(v + c * 2 + F.when(m == 1, 5).otherwise(0)), gap,
                 n(v + c * 9), gap, n(c * 7 + F.when(m == 2, 5).when(m == 1, -5).otherwise(0))),
        F.lit("Revenues over (under) expenditures   1,000   2,000"), F.lit("Revenues"),
        F.concat(F.lit("Late line ignored"), gap, n(v), gap, n(v)))
    pages = t.orders.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_no"), text.alias("text"))
    from footings.plans.statements import flat_statements

    return flat_statements(pages)[0]


@query("d14_published_lines", """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS d, floor(o_totalprice)::DOUBLE AS v, o_orderkey % 3 AS m FROM orders),
b AS (SELECT d, min(k) AS k FROM o WHERE m = 0 GROUP BY 1), s AS (SELECT o.* FROM o JOIN b USING (k))
SELECT s.d AS doc_id, k AS page_no, 'revenues' AS section, CASE j WHEN 0 THEN 'Ad valorem taxes' ELSE 'Intergovernmental revenues restricted by grant agreement or by state statute' END AS line,
  CAST(i AS INTEGER) AS column_index, CASE j WHEN 0 THEN v + i ELSE 500 END AS value, v + i + 500 AS total FROM s, range(2) r(i), range(2) q(j)""")
def d14_lines(t):
    """Lines of proven columns; a long label belongs to its section, and figures that are no row leave it unproven."""
    from footings.plans.statements import flat_statements

    v, m = F.floor("o_totalprice"), F.col("o_orderkey") % 3
    n = lambda x: F.format_number(x, 0)
    gap = F.lit("   ")
    text = text_of(
        F.lit("Budget and Actual  General Fund"), F.lit("Revenues:"), F.concat(F.lit("Ad valorem taxes"), gap, n(v), gap, n(v + 1)),
        F.when(m < 2, F.concat(F.lit("Intergovernmental revenues restricted by grant agreement or by state statute"), gap, F.lit("500   500"))),
        F.when(m == 2, F.lit("Intergovernmental *   500")),
        # Where the long line is left out, or unread, the total of the others must prove nothing.
        F.concat(F.lit("Total revenues"), gap, n(v + F.when(m == 0, 500).otherwise(0)), gap, n(v + 1 + F.when(m == 0, 500).otherwise(0))))
    pages = t.orders.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_no"), text.alias("text"))
    return flat_statements(pages)[1].select("doc_id", "page_no", "section", "line", "column_index", "value", "total")


@query("d12_fold_subtotals", """
WITH s AS (SELECT l_orderkey AS page_no, count(*) AS n FROM lineitem GROUP BY 1)
SELECT page_no, CAST(CASE WHEN n >= 2 THEN n ELSE 0 END AS BIGINT) AS folded, n >= 2 AS proven FROM s""")
def d12(t):
    """A line that sums the run above it is no further line: counting it twice would break the total."""
    from pyspark.sql import Window

    from footings.plans.statements import nested_groups, proven_groups
    from footings.session import stored

    none = F.array(F.lit(None).cast("double"), F.lit(None).cast("double"))
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    lines = t.lineitem.select("l_orderkey", F.row_number().over(w).alias("row_no"), F.concat(F.lit("Line "), "l_partkey").alias("label"),
                              F.array("l_extendedprice", "l_quantity").alias("values"))
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("a"), F.sum("l_quantity").alias("b"))
    rows = lines
    for row_no, label, values in ((0, "ASSETS", none), (90, "Capital assets, net", F.array("a", "b")), (91, "Other line", F.array(F.lit(1.0), F.lit(2.0))),
                                  (92, "Total assets", F.array(F.col("a") + 1, F.col("b") + 2))):
        rows = rows.unionByName(sums.select("l_orderkey", F.lit(row_no).alias("row_no"), F.lit(label).alias("label"), values.alias("values")))
    rows = rows.select(F.lit(1).alias("doc_id"), F.col("l_orderkey").alias("page_no"), "row_no", "label", F.lit(10.0).alias("indent"), "values",
                       F.exists("values", lambda x: x.isNotNull()).alias("has_figures"))
    parts = stored(nested_groups(rows))
    groups, _ = proven_groups(parts)
    folded = parts.groupBy("page_no").agg(F.count_if(F.col("part") == "folded").alias("folded"))
    return folded.join(groups.select("page_no", "proven"), "page_no")


def project_plan(t):
    """Each order as a capital project on two pages; the funding total of some is off."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.floor("l_extendedprice")).alias("a"), F.sum("l_quantity").alias("b"))
    name = F.concat_ws("/", F.lit("ACCOUNT"), "l_linenumber", "l_partkey", "l_suppkey", F.format_number("l_quantity", 0))
    row = F.concat(name, F.lit(" $"), whole("l_extendedprice"), F.lit(" $"), F.format_number("l_quantity", 0))
    body = joined(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], LINE_ORDER, row)
    orders = t.orders.join(sums, "o_orderkey").join(body, "o_orderkey")
    amount = F.concat(F.lit("AMOUNT $"), F.format_number("a", 0), F.lit(" $"), F.format_number("b", 0))
    one = text_of(F.lit("7"), F.concat(F.lit("Pump station"), F.lit(" upgrade")), F.concat(F.lit("phase "), k), F.lit("Capital Improvement Project (FY27 - FY33)"),
                  F.lit("Fund Department Priority Rank"), F.concat(F.lit("Water Fund  Dept-"), c, F.lit("  3")), F.lit("Project Description"),
                  F.lit("First line of"), F.lit(""), F.lit("the description."), F.lit("Project Expenditures"),
                  F.lit("Itemization Description Current Project Budget FY27"), F.lit("Amount"), F.col("body"), amount)
    two = text_of(F.lit("Project Funding"), F.lit("Itemization Description"), F.concat(F.lit("Empty Values $"), F.format_number("a", 0)),
                  F.concat(F.lit("AMOUNT $"), F.format_number(F.col("a") + F.when(c % 5 == 0, 2).otherwise(0), 0)),
                  F.lit("Operating Budget Impact"), F.lit("Object Code Description FY27"),
                  F.concat(F.when(c % 2 == 0, F.lit("DEBT SERVICE - BONDS")).otherwise(F.lit("BUILDINGS")), F.lit(" $"), F.format_number(c + 1, 0)),
                  F.lit("INSURANCE $0"), F.concat(F.lit("AMOUNT $"), F.format_number(c + 1, 0)))
    return orders.select(F.floor(k / PER_DOC).alias("doc_id"), F.explode(F.array(
        F.struct((k % PER_DOC * 3 + 1).alias("page_no"), one.alias("text")), F.struct((k % PER_DOC * 3 + 2).alias("page_no"), two.alias("text")),
        F.struct((k % PER_DOC * 3 + 3).alias("page_no"), F.lit("Project Expenditures\nNOT OURS $5\nAMOUNT $9").alias("text")))).alias("p")) \
        .select("doc_id", "p.page_no", "p.text")


@query("d06_project_register", """
WITH s AS (SELECT l_orderkey AS k, sum(floor(l_extendedprice)) + sum(l_quantity) AS cost FROM lineitem GROUP BY 1)
SELECT k // 1000 AS doc_id, k % 1000 * 3 + 1 AS start_page, 'Pump station upgrade phase ' || k AS title, 'Water Fund' AS fund, 'Dept-' || o_custkey AS department, CAST(3 AS INTEGER) AS priority_rank,
  cost::DOUBLE AS total_planned_cost, CASE WHEN o_custkey % 2 = 0 THEN o_custkey + 1 ELSE 0 END::DOUBLE AS recurring_portion, o_custkey % 5 <> 0 AS published, o_custkey % 2 = 0 AS creates_recurring_cost, 'First line of the description.' AS description
FROM s JOIN orders ON o_orderkey = k""")
def d06(t):
    from footings.plans.projects import project_register

    projects, _, prose_rows = project_register(project_plan(t))
    said = prose_rows.filter("section = 'description'").select("doc_id", "start_page", F.col("prose").alias("description"))
    return projects.join(said, ["doc_id", "start_page"], "left")


@query("d06_project_checks", """
WITH s AS (SELECT l_orderkey AS k, sum(floor(l_extendedprice))::DOUBLE AS a, sum(l_quantity)::DOUBLE AS b FROM lineitem GROUP BY 1),
p AS (SELECT k // 1000 AS doc_id, k % 1000 * 3 + 1 AS start_page, a, b, CASE WHEN o_custkey % 5 = 0 THEN 2 ELSE 0 END AS off FROM s JOIN orders ON o_orderkey = k)
SELECT doc_id, start_page, 'expenditures' AS "table", CAST(i AS INTEGER) AS column_index, CASE i WHEN 0 THEN a ELSE b END AS sum_of_lines, CASE i WHEN 0 THEN a ELSE b END AS printed_total, TRUE AS reconciles FROM p, range(2) r(i)
UNION ALL SELECT doc_id, start_page, 'funding', 0, a, a + off, off = 0 FROM p""")
def d06_checks(t):
    from footings.plans.projects import project_checks

    return project_checks(project_plan(t))


@query("d06_project_fields", """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_custkey % 3 AS m FROM orders)
SELECT k // 1000 AS doc_id, k % 1000 * 5 + 1 AS start_page, 'FY2027-FY2033' AS plan_window, concat_ws(',', k % 1000 * 5 + 1, k % 1000 * 5 + 2, k % 1000 * 5 + 3, k % 1000 * 5 + 4) AS pages,
  CASE m WHEN 0 THEN 'No FY27-29 operating impact.' WHEN 1 THEN 'Upkeep will rise with the size of the site.' END AS operating_budget_impact,
  CASE WHEN m = 2 THEN c + 1 END::DOUBLE AS impact_total, m > 0 AS has_stated_budget_impact FROM o""")
def d06_fields(t):
    from footings.plans.projects import project_fields

    return project_fields(long_project_plan(t)).withColumn("pages", F.array_join(F.col("source_pages").cast("array<string>"), ",")).drop("source_pages")


def long_project_plan(t):
    """Each order as a project of four pages: its description names the last section, its table stands on the third page."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    one = text_of(F.concat(F.lit("Reservoir "), k), F.lit("Capital Improvement Project (FY27 - FY33)"), F.lit("Fund Department Priority Rank"),
                  F.concat(F.lit("Water Fund  Dept-"), c, F.lit("  3")), F.lit("Project Description"),
                  F.lit("Costs to run it are under Operating Budget Impact below."))
    three = text_of(F.lit("Project Expenditures"), F.lit("Itemization Description FY27"), F.concat(F.lit("LAND $"), F.format_number(c + 7, 0)),
                    F.concat(F.lit("WORKS $"), F.format_number(c, 0)), F.concat(F.lit("AMOUNT $"), F.format_number(c * 2 + 7 + F.when(c % 5 == 0, 500).otherwise(0), 0)))
    impact = F.when(c % 3 == 0, F.lit("No FY27-29 operating impact.")).when(c % 3 == 1, F.lit("Upkeep will rise with\nthe size of the site.")).otherwise(
        F.concat(F.lit("Object Code Description FY27\nDEBT SERVICE - BONDS $"), F.format_number(c + 1, 0), F.lit("\nAMOUNT $"), F.format_number(c + 1, 0)))
    four = text_of(F.lit("Operating Budget Impact"), impact)
    texts = [one, F.lit("A drawing of the site"), three, four, F.lit("An appendix\nProject Expenditures\nNOT OURS $5")]
    return t.orders.select(F.floor(k / PER_DOC).alias("doc_id"), F.explode(F.array(*[
        F.struct((k % PER_DOC * 5 + 1 + i).alias("page_no"), x.alias("text")) for i, x in enumerate(texts)])).alias("p")).select("doc_id", "p.page_no", "p.text")


def request_pages(t, forms=True):
    """Each customer's funded and unfunded lists, a page per two hundred order numbers, and a form for every urgent order."""
    k = F.col("o_orderkey")
    item = F.concat(F.lit("Clerk-"), k + 100000, F.lit(" vehicles $"), whole("o_totalprice"), F.lit(" $"), F.format_number(k % 100 + 1, 0))
    orders = t.orders.withColumn("o_funded", F.col("o_orderstatus") == "F")
    lists = orders.groupBy("o_custkey", F.floor(k / 200).alias("page_no"), "o_funded").agg(
        F.array_join(F.sort_array(F.collect_list(item)), "\n").alias("body"), F.sum(F.floor("o_totalprice")).alias("a"), F.sum(k % 100 + 1).alias("b"))
    off = F.when((F.col("o_custkey") % 9 == 0) & ~F.col("o_funded"), 1).otherwise(0)
    kind = F.when(F.col("o_funded"), "Funded").otherwise("Unfunded")
    part = text_of(F.concat(kind, F.lit(" Noteworthy Requests")), F.concat(F.lit("Fund-"), F.col("o_custkey") % 7, F.lit(": "), kind, F.lit(" Noteworthy Requests")),
                   F.lit("Line Item Description FY27 FY28"), F.col("body"),
                   F.concat(F.lit("AMOUNT $"), F.format_number(F.col("a") + off, 0), F.lit(" $"), F.format_number("b", 0)))
    listed = lists.groupBy("o_custkey", "page_no").agg(F.array_join(F.sort_array(F.collect_list(part)), "\n").alias("text")) \
        .select(F.col("o_custkey").alias("doc_id"), "page_no", "text")
    if not forms:
        return listed
    form = text_of(F.concat(F.lit("Vehicles of the Clerk "), k + 100000, F.when(k % 2 == 0, F.lit(" replacement request")).otherwise(F.lit(" extra"))),
                   F.lit("Budget Justification Form (FY27 - FY29)"), F.lit("Fund Department Priority Rank"), F.concat(F.lit("Water Fund Dept-"), k, F.lit(" None")),
                   F.lit("Request Description"), F.lit("Needed."), F.lit("Alternatives & Operational Impact if Not Funded"),
                   F.when(k % 3 == 0, F.lit("N/A")).otherwise(F.lit("It could be funded by fees.")))
    forms = t.orders.filter("o_orderpriority = '1-URGENT'").select((F.col("o_custkey") + 10**9).alias("doc_id"), k.alias("page_no"), form.alias("text"))
    return listed.unionByName(forms)


@query("d07_trade_offs", """
SELECT 'Clerk-' || (o_orderkey + 100000) || ' vehicles' AS request, CASE WHEN o_orderstatus = 'F' THEN 'funded' ELSE 'unfunded' END AS status, 'Fund-' || o_custkey % 7 AS fund, floor(o_totalprice)::DOUBLE AS first_year,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'name variant' ELSE 'no form found' END AS basis, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Dept-' || o_orderkey END AS department,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 <> 0 THEN 'It could be funded by fees.' END AS impact_if_not_funded, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey % 3 <> 0 END AS states_alternative
FROM orders WHERE NOT (o_custkey % 9 = 0 AND o_orderstatus <> 'F')""")
def d07(t):
    from footings.plans import projects

    pages = request_pages(t)
    found = projects.trade_offs(projects.request_lists(pages), projects.request_forms(pages))
    return found.select("request", "status", "fund", "first_year", "basis", "department", "impact_if_not_funded", "states_alternative")


@query("d07_request_lists", """
WITH s AS (SELECT o_custkey AS doc_id, o_orderkey // 200 AS page_no, o_orderstatus = 'F' AS f, count(*) AS items FROM orders GROUP BY ALL)
SELECT doc_id, page_no, 'Fund-' || doc_id % 7 AS fund, CASE WHEN f THEN 'funded' ELSE 'unfunded' END AS status, CASE WHEN NOT f AND doc_id % 4 = 0 THEN 0 ELSE items END AS items,
  NOT f AND doc_id % 4 = 0 AS stated_none, f OR doc_id % 4 = 0 OR doc_id % 9 <> 0 AS reconciles FROM s""")
def d07_lists(t):
    """A list that says it is empty is a stated none, and adds up."""
    from footings.plans import projects

    pages = request_pages(t, forms=False)
    none = F.regexp_replace("text", r"(?s)(: Unfunded Noteworthy Requests)\n.*?AMOUNT[^\n]*", "$1\nNo unfunded requests.")
    pages = pages.withColumn("text", F.when(F.col("doc_id") % 4 == 0, none).otherwise(F.col("text")))
    return projects.request_list_status(pages).drop("list_no")


@query("d07_request_summary", """
WITH s AS (SELECT 'Fund-' || o_custkey % 7 AS fund, o_orderstatus = 'F' AS f, floor(o_totalprice)::DOUBLE AS v, o_orderpriority = '1-URGENT' AS u FROM orders WHERE NOT (o_custkey % 9 = 0 AND o_orderstatus <> 'F')),
x AS (SELECT fund, CAST(count_if(f) AS BIGINT) AS requests_funded, CAST(count_if(NOT f) AS BIGINT) AS requests_declined, sum(v) FILTER (f) AS funded, sum(v) FILTER (NOT f) AS declined, CAST(count_if(u) AS BIGINT) AS with_form FROM s GROUP BY 1)
SELECT *, round(funded / (funded + declined) * 100, 1) AS share_funded_pct FROM x""")
def d07_summary(t):
    from footings.plans import projects

    pages = request_pages(t)
    found = projects.trade_offs(projects.request_lists(pages), projects.request_forms(pages))
    return projects.request_summary(found, ["fund"])


@query("d08_rate_sets", """
WITH c AS (SELECT c_custkey AS doc_id, (c_custkey + 100) / 100.0::DOUBLE AS r FROM customer),
s AS (SELECT * FROM (VALUES ('water', 'inside', 0), ('water', 'outside', 10), ('sewer', 'inside', 20), ('sewer', 'outside', 30)) v(service, location, plus))
SELECT doc_id, service, location, CAST(2000 AS INTEGER) AS threshold, CAST(2 AS BIGINT) AS pairs, TRUE AS accepted, round(r + plus, 2) AS current_rate, round((r + plus) * 2, 2) AS current_charge,
  round(r + plus + 1, 2) AS recommended_rate, round((r + plus + 1) * 2, 2) AS recommended_charge, round((round(r + plus + 1, 2) / round(r + plus, 2) - 1) * 100, 2) AS increase_pct FROM c, s""")
def d08(t):
    """Each customer's schedule: two rate sets per service and place, one figure off its label, sewer over a page break."""
    from footings.plans.rates import fee_values, rate_sets

    base = (F.col("c_custkey") + 100) / 100.0

    def money(x):
        return F.concat(F.lit("$"), F.format_number(x, 2))

    def block(plus):
        r = base + plus
        return [F.concat(F.lit("Block 1 (0-2,000 gallons/month) "), money(r * 2)), money((r + 1) * 2),
                F.concat(F.lit("Minimum charge "), money(F.lit(99.99))), money(r),
                F.concat(F.lit("Block 2 (> 2,000 gallons/month) "), money(r + 1))]

    one = text_of(F.lit("Water Volume Charges"), F.lit("Inside Town"), *block(0), F.lit("Outside Town"), *block(10), F.lit("Bulk Water sales $1.00"),
                  F.lit("Sewer Volume Charges"), F.lit("Inside Town"), *block(20)[:1])
    two = text_of(*block(20)[1:], F.lit("Outside Town"), *block(30), F.lit("Capital Facilities Fee"))
    pages = t.customer.select(F.col("c_custkey").alias("doc_id"), F.explode(F.array(
        F.struct(F.lit(1).alias("page_no"), F.lit("Fees $4.00").alias("text")), F.struct(F.lit(2).alias("page_no"), one.alias("text")),
        F.struct(F.lit(3).alias("page_no"), two.alias("text")), F.struct(F.lit(4).alias("page_no"), F.lit("Inside Town\nBlock 1 (0-2,000 gallons/month) $7.00").alias("text")))).alias("p")) \
        .select("doc_id", "p.page_no", "p.text")
    return rate_sets(fee_values(pages))


@query("d09_rate_tables", """
WITH e AS (SELECT c_custkey AS d, c_nationkey AS n FROM customer), y AS (SELECT unnest([2016, 2017, 2018, 2019]) AS year), x AS (SELECT unnest([0, 1, 2]) AS x),
v AS (SELECT n, year, x, CASE WHEN d % 50 = 0 AND year = 2018 THEN 0.999 ELSE round(0.1 + n / 1000.0 + x / 100.0 + (year - 2016) / 10.0, 6) END::DOUBLE AS rate, d FROM e, y, x WHERE d % 4 <> 3),
w AS (SELECT n, year, x, rate, count(*) AS c, min(d) AS f FROM v GROUP BY 1, 2, 3, 4)
SELECT n AS nationkey, ['county', 'town', 'school'][x + 1] AS entity, CAST(year AS INTEGER) AS year, CASE WHEN count(*) = 1 THEN min(rate) END AS value, count(*) AS distinct_values, CAST(sum(c) AS BIGINT) AS editions, min(f) AS first_edition,
  CASE WHEN count(*) = 1 THEN 'agreed' ELSE 'disputed' END AS state FROM w GROUP BY 1, 2, 3""")
def d09(t):
    """Each customer is one edition of its nation's table: labelled, by position, or one row short."""
    from footings.operators.aggregates import corroborate
    from footings.plans.rates import rate_tables

    d, n = F.col("c_custkey"), F.col("c_nationkey")

    def rates(x):
        figures = [F.when((d % 50 == 0) & F.lit(y == 2018), F.lit("0 .999")).otherwise(F.format_string(
            "%.4f", 0.1 + n / 1000.0 + x / 100.0 + (y - 2016) / 10.0)) for y in range(2016, 2020)]
        return F.concat_ws("  $ ", *figures)

    names = ["Riverside county", "Town proper", "School district of all"]
    kind = d % 4
    lines = [F.when(kind < 2, F.concat(F.lit(label), F.lit("  "), rates(i))).when((kind == 2) | F.lit(i < 2), rates(i)) for i, label in enumerate(names)]
    text = text_of(F.lit("Direct and Overlapping Rates"), F.lit("Last ten fiscal years"), F.lit("2016 2017 2018 2019"), *lines, F.lit("Note 1"))
    pages = t.customer.select(d.alias("doc_id"), F.lit(9).alias("page_no"), text.alias("text"))
    cells = rate_tables(pages, "Overlapping Rates", list(zip(["county", "town", "school"], names)))
    keyed = cells.join(t.customer.select(d.alias("doc_id"), n.alias("nationkey")), "doc_id")
    return corroborate(keyed, ["nationkey", "entity", "year"], "rate", "doc_id")
