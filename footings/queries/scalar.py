"""Demonstrations of the column functions: figures are printed as text, then read back.

Each oracle reads the numbers the text was printed from, so it does not repeat
the parsing it checks.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.functions import checks, money, text, years
from footings.operators.rules import Rule, check_rows, regex_scalars
from footings.queries.registry import query


def whole(col):
    """A whole-dollar figure printed with thousands separators."""
    return F.format_number(F.floor(col), 0)


@query("f01_parse_money", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE l_linenumber % 4 WHEN 0 THEN l_extendedprice WHEN 1 THEN -l_extendedprice
            WHEN 2 THEN l_extendedprice END AS amount
FROM lineitem""")
def f01(t):
    printed = F.format_number("l_extendedprice", 2)
    kind = F.col("l_linenumber") % 4
    cell = (F.when(kind == 0, F.concat(F.lit(" $"), printed))
            .when(kind == 1, F.concat(F.lit("("), printed, F.lit(")")))
            .when(kind == 2, F.concat(printed, F.lit("%"))).otherwise("TBD"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             money.parse_money(cell).alias("amount"))


@query("f02_parse_money_table", """
SELECT o_orderkey, floor(o_totalprice)::DOUBLE AS first_col, -(o_custkey + 1)::DOUBLE AS second_col,
       TRUE AS third_blank, CAST(4 AS INTEGER) AS cells,
       -floor(o_totalprice / 2)::DOUBLE AS fourth_col
FROM orders""")
def f02(t):
    line = F.concat(F.lit("SALARIES $"), whole("o_totalprice"), F.lit(" ($"),
                    F.format_number(F.col("o_custkey") + 1, 0), F.lit(") – $("),
                    whole(F.col("o_totalprice") / 2), F.lit(")"))
    cells = money.money_list(line)
    return t.orders.select("o_orderkey", cells[0].alias("first_col"), cells[1].alias("second_col"),
                           cells[2].isNull().alias("third_blank"), cells[3].alias("fourth_col"),
                           F.size(cells).alias("cells"))


@query("f03_parse_number_prose", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_linenumber % 2 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS figure
FROM lineitem""")
def f03(t):
    printed = F.format_number("l_extendedprice", 2)
    cell = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("("), printed, F.lit(")%"))) \
        .otherwise(F.concat(F.lit("$"), printed, F.lit("%")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             money.parse_number_prose(cell).alias("figure"))


@query("f04_suffix_money", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE l_linenumber % 4 WHEN 0 THEN l_quantity * 1000 WHEN 1 THEN l_quantity * 1000000
            WHEN 2 THEN (1000 + l_quantity) * 1000 ELSE l_quantity END AS dollars,
       l_linenumber % 4 = 2 AS noted
FROM lineitem""")
def f04(t):
    q = F.format_number("l_quantity", 0)
    kind = F.col("l_linenumber") % 4
    cell = (F.when(kind == 0, F.concat(F.lit("$"), q, F.lit("k")))
            .when(kind == 1, F.concat(F.lit("$"), q, F.lit("M")))
            .when(kind == 2, F.concat(F.lit("$1,0"), F.lpad(q, 2, "0"), F.lit("M")))
            .otherwise(q))
    read = money.suffix_money(cell)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             read["value"].alias("dollars"),
                             read["note"].isNotNull().alias("noted"))


@query("f05_clean_number", """
SELECT o_orderkey, -floor(o_totalprice)::DOUBLE AS loose, -floor(o_totalprice)::DOUBLE AS strict,
       floor(o_totalprice)::DOUBLE AS misgrouped_loose, CAST(NULL AS DOUBLE) AS misgrouped_strict
FROM orders""")
def f05(t):
    boxed = F.concat(F.lit("( "), F.regexp_replace(whole("o_totalprice"), r"^(\d)", "$1 "), F.lit(")"))
    bad = F.regexp_replace(F.floor("o_totalprice").cast("string"), r"(\d\d)$", ",$1")
    return t.orders.select(
        "o_orderkey", money.clean_number(boxed).alias("loose"),
        money.clean_number(boxed, strict=True).alias("strict"),
        money.clean_number(bad).alias("misgrouped_loose"),
        money.clean_number(bad, strict=True).alias("misgrouped_strict"))


@query("f06_parse_ocr_number", """
SELECT o_orderkey, floor(o_totalprice)::DOUBLE AS spaced, CAST(2 AS INTEGER) AS merged_count,
       floor(o_totalprice)::DOUBLE AS merged_first, (400000 + o_custkey)::DOUBLE AS merged_second
FROM orders""")
def f06(t):
    spaced = F.regexp_replace(whole("o_totalprice"), ",", " ")
    merged = money.ocr_numbers(F.concat(whole("o_totalprice"), F.lit(" "),
                                        F.format_number(F.col("o_custkey") + 400000, 0)))
    return t.orders.select(
        "o_orderkey", money.parse_ocr_number(spaced).alias("spaced"),
        F.size(merged).alias("merged_count"), merged[0].alias("merged_first"),
        merged[1].alias("merged_second"))


@query("f07_figures_in", r"""
WITH found AS (
  SELECT doc_id, regexp_extract_all(text, '\(?\$?\s?\d[\d,]{2,}\)?') AS toks,
         regexp_extract_all(text, '\(?\$?\s?\d[\d,\s]{2,}\)?') AS spaced
  FROM documents)
SELECT doc_id, CAST(len(toks) AS INTEGER) AS figures,
       list_max([TRY_CAST(regexp_replace(x, '[^\d]', '', 'g') AS DOUBLE) for x in toks]) AS largest,
       CAST(len([x for x in spaced
             if regexp_matches(trim(replace(replace(x, '$', ''), ' ', ''), '()' || chr(10)),
                               '^(\d{1,3}(,\d{3})*|\d+)$')
            and len(regexp_replace(x, '[^\d]', '', 'g')) >= 3]) AS INTEGER) AS canonical
FROM found""")
def f07(t):
    found = money.figures_in(F.col("text"))
    return t.documents.select(
        "doc_id", F.size(found).alias("figures"),
        F.array_max(F.transform(found, F.abs)).alias("largest"),
        F.size(money.figure_tokens(F.col("text"))).alias("canonical"))


@query("f08_fiscal_year", """
SELECT o_orderkey, CASE WHEN o_custkey % 5 = 4 THEN NULL
       ELSE CAST(year(o_orderdate) + 10 AS INTEGER) END AS fiscal_year
FROM orders""")
def f08(t):
    y = F.year("o_orderdate") + 10
    kind = F.col("o_custkey") % 5
    printed = (F.when(kind == 0, F.concat(F.lit("for the year ended June 30, "), y))
               .when(kind == 1, F.concat(F.lit("Plan FY"), y, F.lit(" adopted")))
               .when(kind == 2, F.concat(F.lit("fy "), F.lpad((y % 100).cast("string"), 2, "0")))
               .when(kind == 3, F.concat(F.lit("Fiscal Year "), y, F.lit(" FYI")))
               .otherwise(F.concat(F.lit("minutes of "), y)))
    return t.orders.select("o_orderkey", years.fiscal_year(printed).alias("fiscal_year"))


@query("f09_report_year", """
SELECT o_orderkey, CASE WHEN o_custkey % 5 = 4 THEN NULL
       ELSE CAST(year(o_orderdate) + 10 AS INTEGER) END AS report_year
FROM orders""")
def f09(t):
    y = F.year("o_orderdate") + 10
    kind = F.col("o_custkey") % 5
    name = (F.when(kind == 0, F.concat(F.lit("CAFR_Issued_FY"), y, F.lit(".pdf")))
            .when(kind == 1, F.concat(F.lit("Audit "), y, F.lit(".pdf")))
            .when(kind == 2, F.concat(F.lit("Notes_FY_"), F.lpad((y % 100).cast("string"), 2, "0"),
                                      F.lit(".docx")))
            .when(kind == 3, F.concat(F.lit("June 30, "), y, F.lit(".pdf")))
            .otherwise(F.concat(F.lit("minutes "), y, F.lit(".pdf"))))
    return t.orders.select("o_orderkey", years.report_year(name).alias("report_year"))


@query("f10_fy_id", """
SELECT o_orderkey, 'FY' || year(o_orderdate) AS from_year,
       'FY' || (2000 + year(o_orderdate) % 100) AS from_short,
       'FY' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS short_id
FROM orders""")
def f10(t):
    y = F.year("o_orderdate")
    short = years.fy_short(y)
    return t.orders.select("o_orderkey", years.fy_id(y).alias("from_year"),
                           years.fy_id(short).alias("from_short"), short.alias("short_id"))


@query("f11_keys", """
SELECT p_partkey, replace(p_name, ' ', '-') || '-' || lower(replace(p_brand, '#', '-')) AS slug,
       lower(replace(p_name, ' ', '') || replace(p_brand, '#', '')) AS norm_key,
       replace(p_name, ' ', '_') || '_' || replace(p_brand, '#', '_') AS header,
       replace(p_name, ' ', '') || lower(replace(p_brand, '#', '')) AS title_key
FROM part""")
def f11(t):
    label = F.concat_ws(" -- ", "p_name", "p_brand")
    return t.part.select(
        "p_partkey", text.slug(F.concat(label, F.lit(".pdf"))).alias("slug"),
        text.norm_key(label).alias("norm_key"),
        text.norm_header(F.concat(F.lit(" "), label, F.lit(" "))).alias("header"),
        text.title_key(F.concat(label, F.lit(".PDF"))).alias("title_key"))


@query("f12_looks_doubled", """
SELECT p_partkey, p_partkey % 2 = 0 AS doubled FROM part""")
def f12(t):
    twice = F.regexp_replace("p_name", r"(\w)", "$1$1")
    printed = F.when(F.col("p_partkey") % 2 == 0, twice).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", text.looks_doubled(printed).alias("doubled"))


@query("f13_strip_footer", """
SELECT o_orderkey, 'SALARIES $' || CAST(floor(o_totalprice)::BIGINT AS VARCHAR) AS with_money,
       'TRANSFER TO FUND 69' AS without_money
FROM orders""")
def f13(t):
    line = F.concat(F.lit("SALARIES $"), F.floor("o_totalprice").cast("string"), F.lit(" "),
                    (F.col("o_orderkey") % 1000).cast("string"))
    return t.orders.select("o_orderkey", text.strip_footer(line).alias("with_money"),
                           text.strip_footer(F.lit("TRANSFER TO FUND 69")).alias("without_money"))


SEGMENT_FUNDS = {"building": "Building Fund", "machinery": "Machinery Fund",
                 "household": "Household Fund"}


@query("f14_canon_fund", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building Fund'
       WHEN 'MACHINERY' THEN 'Machinery Fund' WHEN 'HOUSEHOLD' THEN 'Household Fund' END AS fund
FROM customer""")
def f14(t):
    raw = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("   Fund  - "))
    return t.customer.select("c_custkey", text.canon_prefix(raw, SEGMENT_FUNDS).alias("fund"))


@query("f15_destination", """
SELECT o_orderkey,
       CASE o_custkey % 4 WHEN 0 THEN 'Capital Fund' WHEN 1 THEN 'Reserve Fund'
            WHEN 2 THEN 'Debt Service Fund' ELSE 'Unidentified' END AS to_fund,
       CASE o_custkey % 4 WHEN 0 THEN 'fund number 60' WHEN 1 THEN 'fund number 78'
            WHEN 2 THEN 'named in the account' ELSE 'the account name does not say' END AS resolved_by
FROM orders""")
def f15(t):
    kind = F.col("o_custkey") % 4
    account = (F.when(kind == 0, "TRANSFER TO FUND 60 - GENERAL").when(kind == 1, "Transfer to fund 78")
               .when(kind == 2, "TRANSFER TO DEBT  SERVICE").otherwise("TRANSFER TO FUND 99"))
    to = text.destination(account, {"60": "Capital Fund", "78": "Reserve Fund"},
                          [(r"(?i)DEBT\s+SERVICE", "Debt Service Fund")])
    return t.orders.select("o_orderkey", to["to_fund"].alias("to_fund"),
                           to["resolved_by"].alias("resolved_by"))


NAME_ABBREVIATIONS = [(r"\bn\.?(?=\s|$)", "north"), (r"\bdept\.?(?=\s|$)", "department")]
NAME_STOP = ["the", "of", "fund", "replacement"]


@query("f16_tokens", """
SELECT p_partkey, list_sort(['department', 'north'] || string_split(p_name, ' '))[1] AS first_token,
       CAST(4 AS INTEGER) AS n_tokens
FROM part""")
def f16(t):
    title = F.concat(F.lit("Replacement of the "), F.initcap("p_name"), F.lit(" - N. Dept of fund N."))
    words = F.array_sort(text.tokens(title, NAME_ABBREVIATIONS, NAME_STOP))
    return t.part.select("p_partkey", words[0].alias("first_token"), F.size(words).alias("n_tokens"))


@query("f17_money_row", """
SELECT o_orderkey, o_orderpriority AS label, floor(o_totalprice)::DOUBLE AS first_amount,
       -(o_custkey + 1)::DOUBLE AS second_amount, CAST(2 AS INTEGER) AS n_amounts
FROM orders""")
def f17(t):
    line = F.concat(F.col("o_orderpriority"), F.lit(" $"), whole("o_totalprice"), F.lit(" $("),
                    F.format_number(F.col("o_custkey") + 1, 0), F.lit(")"))
    row = money.money_row(line)
    return t.orders.select("o_orderkey", row["label"].alias("label"),
                           row["amounts"][0].alias("first_amount"),
                           row["amounts"][1].alias("second_amount"),
                           F.size(row["amounts"]).alias("n_amounts"))


@query("f22_cents_equivalent", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice / l_discount END AS cents
FROM lineitem""")
def f22(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        checks.cents_equivalent(F.col("l_extendedprice"), F.col("l_discount")).alias("cents"))


@query("f23_budget_variance", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_tax > l_discount THEN 'over' WHEN l_tax < l_discount THEN 'under'
            ELSE 'exact' END AS direction,
       abs((l_discount - l_tax) / l_discount * 100) AS pct
FROM lineitem WHERE l_discount > 0
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, NULL, NULL FROM lineitem WHERE l_discount = 0""")
def f23(t):
    v = checks.budget_variance(F.col("l_discount"), F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             v["direction"].alias("direction"), v["pct"].alias("pct"))


@query("f30_spread_pct", """
SELECT o_custkey, round((max(o_totalprice) - min(o_totalprice)) / abs(min(o_totalprice)) * 100, 1)
         AS spread_pct
FROM orders GROUP BY o_custkey""")
def f30(t):
    return (t.orders.groupBy("o_custkey")
            .agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
            .select("o_custkey", checks.spread_pct(F.col("lo"), F.col("hi")).alias("spread_pct")))


@query("f31_fiscal_bounds", """
SELECT o_orderkey, CAST(year(o_orderdate) - 1 AS VARCHAR) || '-07-01' AS starts,
       CAST(year(o_orderdate) AS VARCHAR) || '-06-30' AS ends
FROM orders""")
def f31(t):
    b = years.fiscal_bounds(F.year("o_orderdate"))
    return t.orders.select("o_orderkey", b["starts"].cast("string").alias("starts"),
                           b["ends"].cast("string").alias("ends"))


@query("f32_verbatim", r"""
WITH q AS (SELECT doc_id, text, string_split(text, chr(10))[-1] AS quote FROM documents)
SELECT doc_id, contains(text, replace(quote, ' ', '  ')) AS exact, TRUE AS collapsed FROM q""")
def f32(t):
    quote = F.regexp_replace(F.element_at(F.split("text", "\n"), -1), " ", "  ")
    return t.documents.select("doc_id", text.verbatim(F.col("text"), quote).alias("exact"),
                              text.verbatim(F.col("text"), quote, exact=False).alias("collapsed"))


DOCUMENT_RULES = [
    Rule("first_octet", r"\b(\d{1,3})\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "count", "stated"),
    Rule("card_number", r"\b(\d{16})\b", "count", "stated"),
    Rule("licence_version", r"Version (\d\.\d)", "ratio", "stated"),
]


@query("f33_regex_scalar", r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents),
rules AS (
  SELECT * FROM (VALUES ('first_octet', '\b(\d{1,3})\.\d{1,3}\.\d{1,3}\.\d{1,3}\b', 'count'),
                        ('card_number', '\b(\d{16})\b', 'count'),
                        ('licence_version', 'Version (\d\.\d)', 'ratio')) r(metric, pattern, unit)),
hits AS (
  SELECT doc_id, metric, min(page) AS page FROM lines JOIN rules ON regexp_matches(line, pattern)
  GROUP BY ALL)
SELECT d.doc_id, r.metric, r.unit, h.page IS NOT NULL AS found, CAST(h.page AS INTEGER) AS page,
       CASE r.metric WHEN 'first_octet' THEN CAST(regexp_extract(l.line, '\b(\d{1,3})\.\d{1,3}\.\d{1,3}\.\d{1,3}\b', 1) AS DOUBLE)
            WHEN 'card_number' THEN CAST(regexp_extract(l.line, '\b(\d{16})\b', 1) AS DOUBLE)
            ELSE CAST(regexp_extract(l.line, 'Version (\d\.\d)', 1) AS DOUBLE) END AS value
FROM documents d CROSS JOIN rules r
LEFT JOIN hits h ON h.doc_id = d.doc_id AND h.metric = r.metric
LEFT JOIN lines l ON l.doc_id = h.doc_id AND l.page = h.page""")
def f33(t):
    pages = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("page", "line")) \
        .withColumn("page", F.col("page") + 1)
    return regex_scalars(pages, DOCUMENT_RULES, "doc_id", "page", "line") \
        .select("doc_id", "metric", "unit", "found", "page", "value")


@query("f34_stated_checks", """
WITH o AS (SELECT o_orderkey, o_totalprice AS stated FROM orders),
     l AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS parts
           FROM lineitem GROUP BY 1),
     j AS (SELECT o_orderkey, stated, parts FROM o LEFT JOIN l ON o_orderkey = l_orderkey)
SELECT o_orderkey, 'within_5pct' AS check_name, abs(parts - stated) / abs(stated) < 0.05 AS agree FROM j
UNION ALL SELECT o_orderkey, 'parts_make_total', abs(parts - stated) < 1 FROM j
UNION ALL SELECT o_orderkey, 'twice_half', abs(stated / 2 * 2 - stated) < 0.01 FROM j""")
def f34(t):
    parts = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("parts"))
    both = t.orders.select("o_orderkey", F.col("o_totalprice").alias("stated")) \
        .join(parts, "o_orderkey", "left")
    stated, got = F.col("stated"), F.col("parts")
    tests = checks.stated_checks([
        ("within_5pct", checks.within_share(got, stated, 0.05)),
        ("parts_make_total", checks.within(got, stated, 1.0)),
        ("twice_half", checks.within(stated / 2 * 2, stated, 0.01))])
    return check_rows(both, ["o_orderkey"], tests).withColumnRenamed("check", "check_name")


@query("f35_project_change", """
SELECT o_orderkey, round((o_totalprice + o_custkey - o_totalprice) / o_totalprice * 100, 1) AS increase_pct,
       abs(o_totalprice + 1200 - (o_totalprice + o_custkey)) < 1000 AS consistent
FROM orders""")
def f35(t):
    original = F.col("o_totalprice")
    change = checks.project_change(original, F.lit(1200.0), original + F.col("o_custkey"))
    return t.orders.select("o_orderkey", change["increase_pct"].alias("increase_pct"),
                           change["consistent"].alias("consistent"))
