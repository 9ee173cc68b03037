"""Reading selection, series, printed order and layout clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.operators import ordered
from footings.operators import windows as ops
from footings.operators.rules import first_hit
from footings.queries.registry import query
from footings.session import spread_pages

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def daily(t):
    """Events with their day: a user's days are the chunks ordered work is split by."""
    return t.events.withColumn("day", F.to_date("ts"))


@query("w01_latest_by", """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def w01(t):
    facts = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("year"),
                            "o_orderdate", "o_orderkey")
    return ops.latest_by(facts, ["o_custkey", "year"], F.col("o_orderdate"), F.col("o_orderkey")) \
        .select("o_custkey", "year", "o_orderkey")


@query("w02_latest", """
SELECT user_id, event_type, arg_max(event_id, (ts, -event_id)) AS event_id FROM events GROUP BY 1, 2""")
def w02(t):
    return ops.latest(t.events, ["user_id", "event_type"], F.col("ts"), F.col("event_id")) \
        .select("user_id", "event_type", "event_id")


@query("w02_for_year", """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1""")
def w02_year(t):
    facts = t.orders.withColumn("year", F.year("o_orderdate"))
    return ops.for_year(facts, ["o_custkey"], "year", 1999, F.col("o_orderdate"), F.col("o_orderkey")) \
        .select("o_custkey", "o_orderkey")


@query("w03_best_basis", """
SELECT o_custkey, arg_min(o_orderkey, (CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 9 END, -year(o_orderdate), CAST(o_orderkey AS VARCHAR))) AS o_orderkey
FROM orders GROUP BY 1""")
def w03(t):
    facts = t.orders.withColumn("year", F.year("o_orderdate"))
    return ops.best_basis(facts, ["o_custkey"], "o_orderpriority", "year", "o_orderkey",
                          {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}).select("o_custkey", "o_orderkey")


@query("w04_last_row", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def w04(t):
    return ops.last_row(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]) \
        .select("l_orderkey", "l_linenumber", "l_partkey")


YEARLY = """
y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2)"""


def yearly(t):
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v"))


@query("w05_yoy", f"""
WITH {YEARLY}, p AS (SELECT *, lag(v) OVER w AS pv, first_value(v) OVER w AS fv FROM y WINDOW w AS (PARTITION BY o_custkey ORDER BY year))
SELECT o_custkey, year, v, round((v - pv) / pv * 100, 2) AS yoy_pct, CASE WHEN pv IS NOT NULL THEN round((v - fv) / fv * 100, 2) END AS change_pct_since_first, round(v - pv, 2) AS delta FROM p""")
def w05(t):
    return ops.yoy(yearly(t), ["o_custkey"], "year", "v")


@query("w05_latest_change", f"""
WITH {YEARLY}, p AS (SELECT *, lag(v) OVER w AS pv, lag(year) OVER w AS py, row_number() OVER (PARTITION BY o_custkey ORDER BY year DESC) AS rn FROM y WINDOW w AS (PARTITION BY o_custkey ORDER BY year))
SELECT o_custkey, py AS prev_year, year AS cur_year, round(v - pv, 2) AS delta FROM p WHERE rn = 1 AND py IS NOT NULL""")
def w05_change(t):
    return ops.latest_change(yearly(t), ["o_custkey"], "year", "v")


@query("w06_grain_ordinal", """
SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, l_quantity,
  row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS line
FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, l_quantity, 1 FROM lineitem WHERE l_linestatus = 'O'
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) = 1""")
def w06(t):
    """Lines of a grain are numbered in printed order, chunk by chunk of line numbers."""
    good, _ = ops.grain_ordinal(t.lineitem, ["l_orderkey", "l_returnflag"], LINE_ORDER,
                                F.col("l_linestatus") == "F", chunk="l_linenumber")
    return good.select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "line")


@query("w06_grain_collisions", """
SELECT l_orderkey, l_returnflag, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 AND count_if(l_linestatus = 'O') > 0""")
def w06_clash(t):
    return ops.grain_ordinal(t.lineitem, ["l_orderkey", "l_returnflag"], LINE_ORDER,
                             F.col("l_linestatus") == "F", chunk="l_linenumber")[1]


@query("w07_fill_down", """
WITH m AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN ts END) OVER w AS fund_at, max(CASE WHEN event_type = 'purchase' THEN ts END) OVER w AS dept_at,
   last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS fund, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS dept,
   last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER w AS cat, max(CASE WHEN event_type = 'click' THEN ts END) OVER w AS cat_at
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, fund, CASE WHEN fund_at IS NULL OR dept_at > fund_at THEN dept END AS dept,
  CASE WHEN (fund_at IS NULL OR cat_at > fund_at) AND (dept_at IS NULL OR cat_at > dept_at) THEN cat END AS cat FROM m""")
def w07(t):
    """A signup stands for a fund heading, a purchase for a department, a click for a category."""
    def heading(kind):
        return F.when(F.col("event_type") == kind, F.col("event_id"))

    return ordered.fill_down(daily(t), ["user_id"], ["ts", "event_id"], {
        "fund": heading("signup"), "dept": heading("purchase"), "cat": heading("click")}, chunk="day") \
        .select("event_id", "fund", "dept", "cat")


@query("w08_gap_islands", """
WITH g AS (SELECT *, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 7200 AS new FROM events)
SELECT event_id, user_id, CAST(sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM g""")
def w08(t):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    return ordered.gap_islands(daily(t), ["user_id"], ["ts", "event_id"], seconds, seconds, 7200.0, "island", "day") \
        .select("event_id", "user_id", "island")


@query("w09_fixed_bands", "SELECT event_id, CAST(round_even(value / 3.0::DOUBLE, 0) AS INTEGER) AS band FROM events")
def w09(t):
    return ops.fixed_bands(t.events, "value").select("event_id", "band")


GRID = """
p AS (SELECT user_id, event_id, round(value, 0) AS x FROM events WHERE value >= 1),
g AS (SELECT *, x - lag(x) OVER (PARTITION BY user_id ORDER BY x, event_id) > 6 AS new FROM p),
i AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY x, event_id ROWS UNBOUNDED PRECEDING) AS island FROM g),
k AS (SELECT user_id, island, count(*) AS hits, max(x) AS edge, min(x) - 3 AS l FROM i GROUP BY 1, 2 HAVING count(*) >= 3)"""


@query("w10_column_grid", f"""
WITH {GRID} SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY edge) - 1 AS INTEGER) AS "column", edge, hits,
  first_value(l) OVER (PARTITION BY user_id ORDER BY edge) - 4 AS boundary FROM k""")
def w10(t):
    points = t.events.filter("value >= 1").select("user_id", "event_id", F.round("value", 0).alias("x1")) \
        .withColumn("x0", F.col("x1") - 3).withColumn("zone", F.floor(F.col("x1") / 50))
    islands = ordered.gap_islands(points, ["user_id"], ["x1", "event_id"], F.col("x1"), F.col("x1"), 6.0, "island", "zone")
    return ops.column_grid(islands, ["user_id"], "island", "x1", "x0")


@query("w11_assemble_tokens", """
WITH g AS (SELECT *, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 7200 AS new FROM events),
i AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM g)
SELECT user_id, CAST(island AS BIGINT) AS island, string_agg(substr(event_type, 1, 1) || CASE WHEN event_type = 'error' THEN '9' ELSE '' END, '' ORDER BY ts, event_id) AS text, min(epoch_us(ts)) AS x0, max(epoch_us(ts)) AS x1,
  max(epoch_us(ts)) FILTER (event_type = 'error') AS digit_x1 FROM i GROUP BY 1, 2""")
def w11(t):
    """Events of one session are the touching marks of a token; an error is a digit."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    marks = ordered.gap_islands(daily(t), ["user_id"], ["ts", "event_id"], seconds, seconds, 7200.0, "island", "day")
    marks = marks.withColumn("x", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn("mark", F.concat(
        F.substring("event_type", 1, 1), F.when(F.col("event_type") == "error", "9").otherwise("")))
    return ops.assemble_tokens(marks.withColumn("x_end", F.col("x")), ["user_id"], "island", "mark", "x", "x_end")


@query("w12_wrap_labels", """
SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN o_orderpriority || ' TRANSFER' WHEN o_custkey % 3 = 1 THEN o_orderpriority || ' ROUND FUND' ELSE o_orderpriority END AS label, o_totalprice AS amount FROM orders
UNION ALL SELECT o_orderkey, 'SECOND ROW', o_totalprice FROM orders""")
def w12(t):
    """Each order prints a table whose first label stands before, around or above its figures."""
    m, label, fig = F.col("o_custkey") % 3, F.col("o_orderpriority"), F.col("o_totalprice")
    none = F.lit(None).cast("double")

    def line(text, amount):
        return F.struct(text.alias("text"), amount.alias("amount"))

    body = (F.when(m == 0, F.array(line(F.lit("Amount header"), none), line(F.concat(label, F.lit(" TRANSFER")), fig)))
            .when(m == 1, F.array(line(F.lit("Itemization"), none), line(F.concat(label, F.lit(" ROUND")), none),
                                  line(F.lit(""), fig), line(F.lit("FUND"), none)))
            .otherwise(F.array(line(F.lit("Itemization"), none), line(label, none), line(F.lit(""), fig))))
    printed = F.concat(body, F.array(line(F.lit("SECOND ROW"), fig)))
    # Orders are spread before their lines are printed: lines compress so well that Spark would join them into few large tasks.
    orders = spread_pages(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"), "o_orderkey")
    lines = orders.select("o_orderkey", F.posexplode(printed).alias("line_no", "l")) \
        .select("o_orderkey", "line_no", F.col("l.text").alias("label"), "l.amount")
    is_row = F.col("amount").isNotNull()
    is_text = ~is_row & (F.col("label") != "") & ~F.col("label").isin("Amount header", "Itemization")
    return ops.wrap_labels(lines, ["o_orderkey"], "line_no", "label", is_row, is_text, "label") \
        .select("o_orderkey", "label", "amount")


@query("w13_stitch_segments", """
SELECT l_orderkey, l_returnflag, string_agg(printf('%.2f', l_extendedprice) || '/' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS amounts
FROM lineitem GROUP BY 1, 2""")
def w13(t):
    rows = t.lineitem.select("l_orderkey", "l_returnflag", F.struct(*LINE_ORDER).alias("seg"),
                             F.array("l_extendedprice", "l_quantity").alias("values"))
    out = ops.stitch_segments(rows, ["l_orderkey"], "l_returnflag", "seg", "values")
    pair = F.transform(F.sequence(F.lit(1), F.size("values"), F.lit(2)), lambda i: F.concat(
        F.format_string("%.2f", F.element_at("values", i)), F.lit("/"), F.element_at("values", i + 1).cast("int").cast("string")))
    return out.select("l_orderkey", "l_returnflag", F.array_join(pair, " ").alias("amounts"))


@query("w14_version_status", """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type <> 'view' THEN ts END AS ts FROM events),
h AS (SELECT user_id, arg_min(event_id, (-epoch_us(ts), event_id)) FILTER (ts IS NOT NULL) AS head, max(ts) AS mx FROM e GROUP BY 1),
s AS (SELECT event_id, head, CASE WHEN ts IS NULL OR mx IS NULL THEN 'unknown — no authoring date' WHEN event_id = head THEN 'CURRENT in its family'
   WHEN floor((epoch_us(mx) - epoch_us(ts)) / 1000000) < 7200 THEN 'same working session' ELSE 'superseded' END AS status FROM e JOIN h USING (user_id))
SELECT event_id, status, CASE WHEN status IN ('same working session', 'superseded') THEN head END AS head FROM s""")
def w14(t):
    files = t.events.select("event_id", "user_id", F.when(F.col("event_type") != "view", F.col("ts")).alias("ts"))
    return ops.version_status(files, "user_id", "event_id", "ts", 7200).select("event_id", "status", "head")


@query("w15_budget_variance", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus = 'F' AS rev, l_extendedprice AS b, l_extendedprice * (1 - l_discount) AS a, l_suppkey % 4 AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN rev THEN a - b ELSE b - a END AS variance_derived, m = 3 AS excluded FROM r""")
def w15(t):
    b, a = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
    derived = F.when(F.col("l_linestatus") == "F", a - b).otherwise(b - a)
    m = F.col("l_suppkey") % 4
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linestatus") == "F", "revenues").otherwise("expenditures").alias("section"),
        b.alias("budget"), a.alias("actual"), F.when(m == 3, derived + 1.5).when(m != 2, derived + 1.4).alias("printed"))
    good, bad = ops.budget_against_actual(rows, "section", "budget", "actual", "printed")
    return good.withColumn("excluded", F.lit(False)).unionByName(bad.withColumn("excluded", F.lit(True))) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "variance_derived", "excluded")


@query("w16_first_hit", """
SELECT conv_id, min(turn) AS turn FROM conversations WHERE regexp_matches(text, '\\b(the|der|de)\\b') GROUP BY 1""".replace("\\\\", "\\"))
def w16(t):
    return first_hit(t.conversations, "conv_id", "turn", "text", r"\b(the|der|de)\b")


@query("w17_vintage", """
WITH v AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_value, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_value, count(*) AS readings,
  arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS a, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS b FROM orders GROUP BY 1, 2)
SELECT o_custkey, year, first_value, last_value, readings, CASE WHEN readings > 1 THEN a || ' → ' || b ELSE CAST(a AS VARCHAR) END AS trail FROM v""")
def w17(t):
    facts = t.orders.withColumn("year", F.year("o_orderdate"))
    return ops.vintage(facts, ["o_custkey", "year"], F.col("o_orderdate"), "o_orderkey", "o_totalprice", "o_orderkey")


@query("w18_section_prose", """
WITH h AS (SELECT conv_id, turn, role, text, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS head FROM conversations),
f AS (SELECT conv_id, min(turn) AS at FROM conversations WHERE role = 'user' GROUP BY 1),
b AS (SELECT h.conv_id, h.turn, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t, row_number() OVER (PARTITION BY h.conv_id ORDER BY turn) AS rn FROM h JOIN f ON f.conv_id = h.conv_id AND h.head = f.at
      WHERE role <> 'user' AND regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '')
SELECT f.conv_id, 'question' AS section, (SELECT string_agg(t, ' ' ORDER BY turn) FROM b WHERE b.conv_id = f.conv_id) AS prose FROM f""".replace("\\\\", "\\"))
def w18(t):
    """The first user turn heads a section; the turns up to the next user turn are its prose."""
    lines = t.conversations.withColumn("line", F.when(F.col("role") == "user", "<<USER>>").otherwise(F.col("text")))
    return ops.section_prose(lines, ["conv_id"], ["turn"], "line", {"question": "^<<USER>>$"})
