"""Sources and sinks over data derived from the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from footings.queries.registry import query
from footings.session import scratch_folder
from footings.sources import cells as cell_ops
from footings.sources import datasets, files, words


@query("s01_read_dataset", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders""")
def s01(t):
    """Orders published as JSON documents of a thousand facts, read back by schema."""
    path = scratch_folder(t.spark, "s01")
    fact = F.struct("o_orderkey", "o_totalprice", "o_orderstatus")
    (t.orders.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("part"))
     .agg(F.collect_list(fact).alias("facts")).write.json(path))
    return datasets.read_dataset(t.spark, path, "o_orderkey long, o_totalprice double, o_orderstatus string",
                                 "facts", multi_line=False)


@query("s02_from_envelope", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem""")
def s02(t):
    row = F.array(F.col("l_returnflag"), F.col("l_linenumber").cast("string"),
                  F.col("l_quantity").cast("string"), F.col("l_orderkey").cast("string"))
    envelopes = t.lineitem.select(
        F.array(*[F.lit(c) for c in ("l_returnflag", "l_linenumber", "l_quantity", "l_orderkey")])
        .alias("columns"), F.array(row).alias("rows"))
    return datasets.from_envelope(
        envelopes, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string")


@query("s03_inventory", """
SELECT doc_id, CAST(strlen(text) AS INTEGER) AS bytes, sha256(text) AS sha256 FROM documents
WHERE strlen(text) > 0""")
def s03(t):
    good, _ = files.content_inventory(t.documents, "doc_id", F.col("text"))
    return good.select("doc_id", "bytes", "sha256")


@query("s03_inventory_files", """
SELECT s_nationkey, CAST(strlen(string_agg(s_name, chr(10) ORDER BY s_name)) + 1 AS BIGINT) AS bytes, sha256(string_agg(s_name, chr(10) ORDER BY s_name) || chr(10)) AS sha256, 'txt' AS extension FROM supplier GROUP BY 1""")
def s03_files(t):
    """A folder with one file per nation, its suppliers one a line, inventoried as files."""
    folder = scratch_folder(t.spark, "s03")
    names = t.supplier.groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list("s_name")), "\n").alias("value"))
    names.write.partitionBy("s_nationkey").text(folder)
    good, _ = files.inventory(t.spark, folder)
    nation = F.regexp_extract("path", r"s_nationkey=(\d+)", 1).cast("bigint")
    return good.select(nation.cast("int").alias("s_nationkey"), F.col("bytes").cast("bigint").alias("bytes"), "sha256", "extension")


@query("s04_word_boxes", """
SELECT event_id, event_type AS text, round(user_id * (72.0::DOUBLE / 300), 2) AS x0,
       round((user_id + 30) * (72.0::DOUBLE / 300), 2) AS x1,
       CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS conf
FROM events
WHERE CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) >= 40 AND event_type <> 'view'
  AND event_id % 7 <> 0""".replace("\\\\", "\\"))
def s04(t):
    raw = t.events.select(
        "event_id", F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")).alias("text"),
        F.col("user_id").cast("string").alias("left"), F.lit("600").alias("top"),
        F.lit("30").alias("width"),
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise("10").alias("height"),
        F.regexp_extract("props", r"(\d+)", 1).alias("conf"))
    return words.word_boxes(raw, ["event_id"]).select("event_id", "text", "x0", "x1", "conf")


@query("s05_to_lines", r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no,
                  unnest(string_split(text, chr(10))) AS raw FROM documents)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, sha256(regexp_replace(raw, '^\s+|\s+$', '', 'g')) AS line_hash
FROM l WHERE regexp_replace(raw, '^\s+|\s+$', '', 'g') <> ''""")
def s05(t):
    return words.to_lines(t.documents, ["doc_id"], "text").select(
        "doc_id", "line_no", F.sha2("line", 256).alias("line_hash"))


def order_sheets(t):
    """Every thousand orders as one worksheet: a title row, a heading row, data rows.

    Pending orders leave their first amount blank.
    """
    sheet = F.floor(F.col("o_orderkey") / 1000).alias("sheet")
    body = t.orders.select(sheet, (F.col("o_orderkey") % 1000 + 5).cast("int").alias("row"), F.explode(F.array(
        F.struct(F.lit(0).alias("col"), F.col("o_orderkey").cast("string").alias("value")),
        F.struct(F.lit(1).alias("col"), F.when(F.col("o_orderstatus") != "P",
                 F.col("o_totalprice").cast("string")).otherwise(" ").alias("value")),
        F.struct(F.lit(2).alias("col"), F.col("o_custkey").cast("string").alias("value")),
        F.struct(F.lit(3).alias("col"), F.col("o_orderpriority").alias("value")))).alias("c"))
    head = t.orders.select(sheet).distinct().select("sheet", F.explode(F.array(
        F.struct(F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit("Request table").alias("value")),
        F.struct(F.lit(2).alias("row"), F.lit(0).alias("col"), F.lit("Order id").alias("value")),
        F.struct(F.lit(2).alias("row"), F.lit(1).alias("col"), F.lit("FY26").alias("value")),
        F.struct(F.lit(2).alias("row"), F.lit(2).alias("col"), F.lit(" FY27").alias("value")),
        F.struct(F.lit(2).alias("row"), F.lit(3).alias("col"), F.lit("Order - priority").alias("value"))))
        .alias("c")).select("sheet", "c.row", "c.col", "c.value")
    return body.select("sheet", "row", "c.col", "c.value").unionByName(head)


@query("s06_records_from_cells", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS fy26, o_custkey AS fy27,
       o_orderpriority AS priority
FROM orders""")
def s06(t):
    rows = cell_ops.records_from_cells(order_sheets(t), ["sheet"],
                                       ["Order_id", "FY26", "FY27", "Order_priority"], "Order_id")
    return rows.select(F.col("Order_id").try_cast("long").alias("o_orderkey"),
                       F.col("FY26").try_cast("double").alias("fy26"),
                       F.col("FY27").try_cast("long").alias("fy27"),
                       F.col("Order_priority").alias("priority"))


@query("d15_overflow_fields", """
SELECT o_orderkey, CAST(1 AS INTEGER) AS n_other, o_orderpriority AS other_priority FROM orders""")
def d15(t):
    rows = cell_ops.records_with_overflow(order_sheets(t), ["sheet"], ["Order_id", "FY26", "FY27"],
                                          "Order_id")
    return rows.select(F.col("Order_id").try_cast("long").alias("o_orderkey"),
                       F.size("other_fields").alias("n_other"),
                       F.col("other_fields")["Order_priority"].alias("other_priority"))


@query("a03_fill_state", """
SELECT o_orderkey // 1000 AS sheet, count(*) * 3 AS cells_expected,
       count(*) * 3 - count_if(o_orderstatus = 'P') AS cells_provided,
       CASE WHEN count_if(o_orderstatus = 'P') = 0 THEN 'answered' ELSE 'partial' END AS status
FROM orders GROUP BY 1""".replace("count_if(o_orderstatus = 'P') AS cells_provided",
                                  "CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS cells_provided"))
def a03(t):
    return cell_ops.fill_state(order_sheets(t), ["sheet"])


@query("a36_profile_cells", """
SELECT o_orderkey // 1000 AS sheet, count(*) + 2 AS rows, FALSE AS has_source_ids,
       FALSE AS has_confidence, bool_or(o_orderpriority = '1-URGENT') AS mentions_urgent,
       CAST(2 AS BIGINT) AS years, CAST(2026 AS INTEGER) AS first_year, CAST(2027 AS INTEGER) AS last_year
FROM orders GROUP BY 1""")
def a36(t):
    return cell_ops.profile_cells(order_sheets(t), ["sheet"], {"urgent": "URGENT"})


@query("d17_request_workbook", """
WITH o AS (SELECT o_orderkey, o_totalprice * 1000 AS original,
                  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + o_custkey AS DOUBLE) * 1000 AS current FROM orders)
SELECT o_orderkey, original, current, round((current - original) / original * 100, 1) AS increase_pct,
       TRUE AS consistent FROM o""")
def d17(t):
    """Project cost changes typed as $…k cells: records, suffix figures, own arithmetic."""
    from footings.functions.money import suffix_money
    from footings.plans.workbook import cost_changes

    sheet = F.floor(F.col("o_orderkey") / 1000).alias("sheet")
    two = F.format_number("o_totalprice", 2)
    body = t.orders.select(sheet, (F.col("o_orderkey") % 1000 + 5).cast("int").alias("row"), F.explode(F.array(
        F.struct(F.lit(0).alias("col"), F.col("o_orderkey").cast("string").alias("value")),
        F.struct(F.lit(1).alias("col"), F.concat(F.lit("$"), two, F.lit("k")).alias("value")),
        F.struct(F.lit(2).alias("col"), F.concat(F.lit("$"), F.format_number(
            F.col("o_totalprice") + F.col("o_custkey"), 2), F.lit("k")).alias("value")),
        F.struct(F.lit(3).alias("col"), F.concat(F.col("o_custkey").cast("string"), F.lit("K")).alias("value"))))
        .alias("c")).select("sheet", "row", "c.col", "c.value")
    head = t.orders.select(sheet).distinct().select("sheet", F.explode(F.array(*[
        F.struct(F.lit(1).alias("row"), F.lit(i).alias("col"), F.lit(h).alias("value"))
        for i, h in enumerate(("Project", "Original", "Current", "Increase"))])).alias("c")) \
        .select("sheet", "c.row", "c.col", "c.value")
    changes = cost_changes(body.unionByName(head), ["sheet"], suffix_money)
    return changes.select(F.col("project").try_cast("long").alias("o_orderkey"), "original", "current",
                          "increase_pct", "consistent")


@query("s07_newest_version", """
WITH f AS (SELECT o_custkey, year(o_orderdate) AS major, month(o_orderdate) AS minor,
                  'Report v' || year(o_orderdate) || '.' || month(o_orderdate) || ' ' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS name
           FROM orders)
SELECT o_custkey, name FROM f QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY major DESC, minor DESC, name DESC) = 1""")
def s07(t):
    named = t.orders.select("o_custkey", F.concat(
        F.lit("Report v"), F.year("o_orderdate"), F.lit("."), F.month("o_orderdate"), F.lit(" "),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("name"))
    return files.newest_version(named, "o_custkey", "name")


@query("s08_write_table", """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem GROUP BY ALL""")
def s08(t):
    """Written partitioned, read back with pruning on the partition columns."""
    path = scratch_folder(t.spark, "s08")
    datasets.write_table(t.lineitem.select("l_returnflag", "l_linestatus", "l_extendedprice"), path,
                         partition_by=["l_returnflag", "l_linestatus"])
    back = t.spark.read.schema("l_extendedprice double, l_returnflag string, l_linestatus string") \
        .parquet(path)
    return back.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"))


@query("s09_index_summary", """
SELECT 'orders' AS dataset, count(*) AS n_rows, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
       CAST(max(year(o_orderdate)) AS INTEGER) AS last_year,
       CAST(max(CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) END) AS INTEGER) AS headline_year,
       count(DISTINCT o_custkey) AS cited FROM orders
UNION ALL
SELECT 'lines', count(*), CAST(min(year(l_shipdate)) AS INTEGER), CAST(max(year(l_shipdate)) AS INTEGER),
       CAST(max(CASE WHEN l_returnflag = 'R' THEN year(l_shipdate) END) AS INTEGER), count(DISTINCT l_suppkey) FROM lineitem
UNION ALL
SELECT 'events', count(*), CAST(min(year(ts)) AS INTEGER), CAST(max(year(ts)) AS INTEGER),
       CAST(max(CASE WHEN event_type = 'purchase' THEN year(ts) END) AS INTEGER), count(DISTINCT user_id) FROM events""")
def s09(t):
    return datasets.index_summary({
        "orders": (t.orders, F.year("o_orderdate"), F.col("o_orderstatus") == "F", F.col("o_custkey")),
        "lines": (t.lineitem, F.year("l_shipdate"), F.col("l_returnflag") == "R", F.col("l_suppkey")),
        "events": (t.events, F.year("ts"), F.col("event_type") == "purchase", F.col("user_id"))})


@query("s10_pending", """
SELECT doc_id FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id FROM documents WHERE lang <> 'en'""")
def s10(t):
    """Documents already labelled count as processed, but only with today's English rules."""
    def keyed(df, version):
        return df.select("doc_id", datasets.work_key(F.sha2(F.col("doc_id").cast("string"), 256),
                                                     "labeller", version, lang="en").alias("work"))

    english = F.col("lang") == "en"
    done = t.labels.select("doc_id").join(t.documents.select("doc_id", "lang"), "doc_id")
    done = keyed(done.filter(english), "2").unionByName(keyed(done.filter(~english), "1")).select("work")
    return datasets.pending(keyed(t.documents, "2"), done, "work").select("doc_id")


@query("s11_dataset_digest", """
WITH h AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1),
     e AS (SELECT n, sha256(h || ':' || n) AS e FROM h),
     s AS (SELECT sum(('0x' || substr(e, 1, 15))::BIGINT) AS a, sum(('0x' || substr(e, 16, 15))::BIGINT) AS b,
           sum(('0x' || substr(e, 31, 15))::BIGINT) AS c, sum(('0x' || substr(e, 46, 15))::BIGINT) AS d, sum(n) AS n FROM e)
SELECT substr(sha256(concat_ws(':', a, b, c, d)), 1, 12) AS digest, CAST(n AS BIGINT) AS members FROM s""")
def s11(t):
    return datasets.dataset_digest(t.documents.select(F.sha2("text", 256).alias("sha")), "sha")


@query("s12_presence", """
SELECT CASE WHEN o.k IS NULL THEN 'missing' WHEN c.k IS NULL THEN 'extra' ELSE 'present' END AS presence,
       coalesce(c.k, o.k) AS custkey
FROM (SELECT DISTINCT o_custkey AS k FROM orders) c
FULL JOIN (SELECT s_suppkey AS k FROM supplier) o ON c.k = o.k""")
def s12(t):
    expected = t.orders.select(F.col("o_custkey").alias("custkey"))
    held = t.supplier.select(F.col("s_suppkey").alias("custkey"))
    return datasets.presence(expected, held, "custkey")
