"""Mixing sources to target weights by weighted fair queueing.

Every shuffled document gets a virtual finish time: the cumulative tokens of its source up
to and including it, divided by the source's target.  The documents of all sources, range
sorted by that time, are the mix; it is truncated at the total budget.  A source whose
target exceeds its size is passed through again, at most `repeats` times in all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from footings.llm.hashing import BITS, hash60, sums_before
from footings.session import truncate_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
TICK_BITS = 40          # finish times are compared in steps of 2**-40 of the whole schedule
DIGIT = 10              # the cut is searched 2**10 cells at a time
SMALL = 4096            # rows among which the cut is settled directly


def words_of(text: Column) -> Column:
    """The number of words of a text (null: 0): maximal runs free of blank, tab and line ends."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Weights dealt to the sources in code-point order, null last, repeating; `_sid` numbers the sources.

    The sources are range sorted and numbered partition by partition, so their count is not bounded.
    """
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    schema = StructType([*ordered.schema.fields, StructField("_sid", LongType())])
    numbered = ordered.rdd.zipWithIndex().map(lambda pair: (*pair[0], pair[1])).toDF(schema)
    choices = F.array(*[F.lit(float(w)) for w in weights])
    return numbered.withColumn("weight", F.element_at(choices, (F.col("_sid") % len(weights) + 1).cast("int")))


def fair_targets(sources: DataFrame, share: float, repeats: int) -> DataFrame:
    """Add `target`: the budget (`share` of all sizes) dealt by weight, no source above `repeats` times its size.

    What a full source leaves is dealt again among the others until none is above.  The
    sources stay a table; only three sums come back per round, and each round fills one
    source at least.
    """
    limit = F.col("source_size") * repeats
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level, filled = share * total, 0.0, -1
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        used, weight, count = sources.agg(
            F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if count == filled or not weight:
            break
        filled, level = count, (budget - (used or 0)) / weight
    share_of = F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.when(limit <= share_of, limit.cast("double")).otherwise(share_of))


def schedule(docs: DataFrame, share: float = SHARE, repeats: int = REPEATS,
             weights: tuple[float, ...] = WEIGHTS, seed: str = "mix") -> tuple[DataFrame, float]:
    """Every document with its place in the queue of its source, and the total budget.

    Columns: doc_id, source, size, _order (the shuffle), source_size, target, _through
    (tokens of the source up to and including the document).
    """
    order = hash60(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                            F.coalesce(F.col("text"), F.lit(""))))
    rows = truncate_lineage(docs.select("doc_id", "source", words_of(F.col("text")).alias("size"),
                                        order.alias("_order")))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    sources = truncate_lineage(cyclic_weights(sources, weights))
    sources = fair_targets(sources, share, repeats)
    count, total = sources.agg(F.sum("_rows"), F.sum("source_size")).first()
    bits = max(7, math.ceil(math.log2(max(1, (count or 0) / SMALL))))
    named = sources.select(F.col("source").alias("_source"), "_sid", "source_size", "target")
    rows = (rows.join(named, rows["source"].eqNullSafe(named["_source"])).drop("_source")
            .withColumn("_cell", F.shiftright("_order", BITS - bits)))
    cells = sums_before(rows.groupBy("_sid", "_cell").agg(F.sum("size").alias("size")), ["_sid"], "_cell", "size", bits)
    inner = F.sum("size").over(Window.partitionBy("_sid", "_cell").orderBy("_order", "doc_id", "size")
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = (rows.withColumn("_inner", inner).join(cells.select("_sid", "_cell", "before"), ["_sid", "_cell"])
              .withColumn("_through", F.col("_inner") + F.col("before")))
    queued = queued.select("doc_id", "source", "size", "_order", "source_size", "target", "_through")
    return truncate_lineage(queued), share * (total or 0)


def _turns(queued: DataFrame, repeats: int) -> DataFrame:
    """One row per document and pass, with its finish time in ticks (`_tick`)."""
    turns = queued.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = F.try_divide(F.col("_through") + F.col("_pass") * F.col("source_size"), F.col("target"))
    return turns.withColumn("_tick", F.floor(finish * float(1 << TICK_BITS)))


def _cut(turns: DataFrame, budget: float) -> tuple | None:
    """The first (tick, order, doc_id, pass) that no longer fits the budget; None if all fit.

    A histogram of 2**DIGIT cells over the finish times finds the cell in which the budget
    runs out, then the same again inside it; ties of one tick go on by the shuffle order.
    Only histograms come back to the driver, and the last few rows.
    """
    turns = turns.filter(F.col("size") > 0)
    spent, inside = 0, F.lit(True)
    for column, bits in (("_tick", TICK_BITS + 4), ("_order", BITS)):
        for shift in range((bits - 1) // DIGIT * DIGIT, -1, -DIGIT):
            digit = F.shiftright(column, shift)
            cells = (turns.filter(inside).groupBy(digit.alias("cell"))
                     .agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy("cell"))
            for cell in cells.toLocalIterator():
                if spent + cell["size"] > budget:
                    break
                spent += cell["size"]
            else:
                return None
            inside = inside & (digit == cell["cell"])
            if cell["n"] <= SMALL:
                break
        if cell["n"] <= SMALL:
            break
    last = turns.filter(inside).groupBy("_tick", "_order", "doc_id", "_pass").agg(F.sum("size").alias("size"))
    for row in last.orderBy("_tick", "_order", "doc_id", "_pass").toLocalIterator():
        if spent + row["size"] > budget:
            return row["_tick"], row["_order"], row["doc_id"], row["_pass"]
        spent += row["size"]
    return None


def mix(docs: DataFrame, share: float = SHARE, repeats: int = REPEATS,
        weights: tuple[float, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, _order.

    * `copies` (0 to `repeats`) says how often the mix takes the document, `taken` its
      words in the mix.  The order depends on id and text alone, so reruns agree.
    * Null or wordless texts have size 0 and are never taken; a null source is a source of
      its own; equal rows share their fate at the cut; a null id counts as the smallest.
    * A source of any size is dealt over cells of the shuffle: no task holds it whole.
    * Extra columns are ignored; an empty table gives no rows.
    """
    queued, budget = schedule(docs, share, repeats, weights, seed)
    cut = _cut(_turns(queued, repeats), budget)
    taken_in = []
    for turn in range(repeats):
        finish = F.try_divide(F.col("_through") + turn * F.col("source_size"), F.col("target"))
        tick = F.floor(finish * float(1 << TICK_BITS))
        if cut is None:
            early = F.lit(True)
        else:
            id_after = F.lit(False) if cut[2] is None else F.coalesce(F.col("doc_id") < F.lit(cut[2]), F.lit(True))
            same_id = F.col("doc_id").eqNullSafe(F.lit(cut[2]))
            early = ((tick < cut[0]) | ((tick == cut[0]) & (F.col("_order") < cut[1]))
                     | ((tick == cut[0]) & (F.col("_order") == cut[1]) & (id_after | (same_id & F.lit(turn < cut[3])))))
        taken_in.append(F.when((F.col("size") > 0) & early, 1).otherwise(0))
    copies = sum(taken_in[1:], taken_in[0])
    return (queued.withColumn("copies", copies.cast("int"))
            .withColumn("taken", F.col("size") * F.col("copies"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "_order"))


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it is taken; the columns stay.

    Rows equal in id and text are interchangeable: their copies are added up and dealt to
    one of them.
    """
    id_text, text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_packed"),
                        hash60(F.concat(F.lit(seed), F.lit(":"), id_text, F.lit(":"), text)).alias("_order"),
                        F.xxhash64("doc_id").alias("_id"))
    copies = (mix(docs, seed=seed, **options).groupBy("_order", F.xxhash64("doc_id").alias("_id"))
              .agg(F.sum("copies").alias("_copies")).filter("_copies > 0"))
    first = F.row_number().over(Window.partitionBy("_order", "_id").orderBy(F.xxhash64("_packed")))
    return (keyed.join(copies, ["_order", "_id"]).withColumn("_first", first).filter("_first = 1")
            .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .select("_packed.*"))


SQL = """
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS o
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM rows GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER lower, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0))::DOUBLE AS level
  FROM sources WINDOW lower AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (
  SELECT level FROM levels WHERE 2 * source_size > level * weight
  ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN 2 * source_size <= (SELECT level FROM chosen) * weight THEN (2 * source_size)::DOUBLE
              ELSE (SELECT level FROM chosen) * weight::DOUBLE END AS target FROM sources),
queued AS (
  SELECT r.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY r.source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS through
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, floor((through + p * source_size)::DOUBLE / target * 1099511627776::DOUBLE)::BIGINT AS tick
  FROM queued, range(2) AS t(p) WHERE size > 0),
served AS (
  SELECT *, sum(size) OVER (ORDER BY tick, o, doc_id, p ROWS UNBOUNDED PRECEDING) AS spent FROM turns),
mixed AS (
  SELECT doc_id, o, sum(size)::BIGINT AS taken FROM served
  WHERE spent <= (SELECT 1.5::DOUBLE * sum(size) FROM rows) GROUP BY doc_id, o)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(m.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN mixed m ON q.doc_id = m.doc_id AND q.o = m.o
"""
