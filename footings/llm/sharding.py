"""Extendible hashing: byte-limited shards from a directory of hash-prefix bits.

A shard is a prefix of the hash of the document's key and text, and of an ordinal where both
repeat, so no key holds more together than one document.  The root holds everything; only a
bucket above the byte limit is split on one more bit, so large and small shards coexist
and the directory is no deeper than the data ask for.

The first pass looks at STRIDE bits, each later one at NEXT_BITS more of the cells that are still
too large, so a pass lists at most 2**NEXT_BITS cells for each of those.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.llm.hashing import BITS, STRIDE, hash60
from footings.llm.tables import written
from footings.session import truncate_lineage

NEXT_BITS = 4                 # of a pass after the first
SHARD_BYTES = 64 << 20
QUERY_BYTES = 256 << 10       # limit of the registered query, which splits on every table given


def _prefix(hash_column: Column | str, depth: int | Column) -> Column:
    """The first `depth` bits of a 60-bit hash as a number."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", F.col(hash_column) if isinstance(hash_column, str) else hash_column,
                           (F.lit(BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int) -> tuple[DataFrame, list[int]]:
    """Leaves of the directory: (cell_depth, prefix, depth, shard_bytes, shard_docs, oversize).

    `rows` holds `_hash` and `n_bytes`.  Each pass sums bytes per cell some bits deeper
    (partial sums before the shuffle), rolls the cells up to every depth on the way and
    keeps the smallest depth that fits.  Cells still too large at the last depth go to the
    next pass, which reads their rows only; passes end when none is left or all bits are
    used.  One document that is too large on its own is too large at every depth: its leaf, all
    bits long, is known by the cell that it has for itself.  Also returns the depths at which the
    passes ended.
    """
    leaves, ends, crowded, start = [], [], None, 0
    while start < BITS:
        end = start + (STRIDE if crowded is None else NEXT_BITS)
        source = rows.withColumn("_cell", _prefix("_hash", end))
        if crowded is not None:
            source = (source.withColumn("_top", _prefix("_hash", start))
                      .join(crowded.select(F.col("prefix").alias("_top")), "_top", "left_semi"))
        cells = source.groupBy("_cell").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
        first = start + 1 if crowded is not None else 0
        levels = truncate_lineage(
            cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(end))))
            .withColumn("prefix", F.call_function("shiftright", F.col("_cell"), F.lit(end) - F.col("depth")))
            .groupBy("depth", "prefix")
            .agg(F.sum("shard_bytes").alias("shard_bytes"), F.sum("shard_docs").alias("shard_docs")))
        alone = (F.col("depth") == end) & (F.col("shard_docs") == 1)
        fits = (F.col("shard_bytes") <= limit) | (F.col("depth") == BITS) | alone
        split = levels.filter(~fits)
        parents = split.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_parent"))
        below = (levels.filter(fits & (F.col("depth") > first))
                 .withColumn("_parent", F.shiftright("prefix", 1))
                 .join(parents, ["depth", "_parent"]).drop("_parent"))
        leaves.append(below.unionByName(levels.filter(fits & (F.col("depth") == first))))
        ends.append(end)
        crowded = split.filter(F.col("depth") == end).select("prefix")
        if crowded.isEmpty():
            break
        start = end
    found = reduce(DataFrame.unionByName, leaves).withColumnRenamed("depth", "cell_depth")
    oversize = F.col("shard_bytes") > limit
    return found.select("cell_depth", "prefix", F.when(oversize, BITS).otherwise(F.col("cell_depth")).alias("depth"),
                        "shard_bytes", "shard_docs", oversize.alias("oversize")), ends


def hashed_rows(docs: DataFrame, key: str, text: str, **carried: Column) -> DataFrame:
    """key, n_bytes, `_hash` and what is carried along: rows of one key and text get an ordinal, the others none."""
    named = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    rows = docs.select(F.col(key), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint").alias("n_bytes"),
                       named.alias("_name"), F.monotonically_increasing_id().alias("_ordinal"),
                       *[c.alias(name) for name, c in carried.items()])
    again = rows.groupBy("_name").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1)
    name = F.when(F.col("_rows").isNull(), F.col("_name")).otherwise(F.concat("_name", F.lit(":"), F.col("_ordinal").cast("string")))
    return rows.join(again, "_name", "left").select(key, "n_bytes", hash60(name).alias("_hash"), *carried)


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, shard, depth, shard_bytes, shard_docs, oversize.

    * `shard` is the leaf's bits as text (the root: empty), a unique and sortable name.
    * A null text weighs 0 bytes; a null key hashes like an empty one.
    * Rows of one key have hashes of their own if their texts differ, and repeated rows by an ordinal
      of the scan.  A shard above the limit is left only where one document is larger than the
      limit on its own; it is marked `oversize`.
    * Extra columns are ignored; an empty table gives no rows.
    """
    # Passes and placement read the small rows, not the texts again.
    return _placed(written(hashed_rows(docs, key, text), "shard-rows"), limit, key)


def _placed(rows: DataFrame, limit: int, key: str, *carried: str) -> DataFrame:
    leaves, ends = directory(rows.select("n_bytes", "_hash"), limit)
    # The directory proper: every cell of a pass points to its leaf, so that rows find it
    # by equality.
    placed, start = rows, 0
    wanted = ["depth", "shard_bytes", "shard_docs", "oversize"]
    for number, end in enumerate(ends):
        own = leaves.filter((F.col("cell_depth") > start) | (F.lit(number == 0) & (F.col("cell_depth") == 0)))
        own = own.filter(F.col("cell_depth") <= end)
        span = F.lit(end) - F.col("cell_depth")
        base = F.call_function("shiftleft", F.col("prefix"), span)
        cells = own.select(
            F.explode(F.sequence(base, base + F.call_function("shiftleft", F.lit(1).cast("bigint"), span) - 1))
            .alias("_cell"), *[F.col(c).alias(f"_{number}_{c}") for c in wanted])
        placed = placed.withColumn("_cell", _prefix("_hash", end)).join(cells, "_cell", "left").drop("_cell")
        start = end
    chosen = [F.coalesce(*[F.col(f"_{n}_{c}") for n in range(len(ends))]).alias(c) for c in wanted]
    placed = placed.select(key, "n_bytes", "_hash", *chosen, *carried)
    bits = F.lpad(F.conv(F.col("_hash").cast("string"), 10, 2), BITS, "0")
    return placed.select(key, "n_bytes", F.substring(bits, F.lit(1), F.col("depth")).alias("shard"),
                         F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_docs", "oversize", *carried)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Write `docs` as one Parquet folder per shard under `path`; returns (shard, shard_bytes, shard_docs) of those."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    placed = _placed(hashed_rows(docs, key, text, _row=row), limit, key, "_row")
    (placed.select(F.col("_row"), F.concat(F.lit("b"), "shard").alias("_shard")).select("_row.*", F.col("_shard").alias("shard"))
     .repartition("shard").write.partitionBy("shard").parquet(path))
    return placed.select("shard", "shard_bytes", "shard_docs").distinct()


SQL = f"""
WITH named AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS name
  FROM documents),
rows AS (SELECT doc_id, n_bytes, ('0x' || substr(md5(name), 1, 15))::BIGINT AS h FROM named),
prefixes AS (
  SELECT d::INTEGER AS depth, h >> (60 - d)::BIGINT AS prefix,
         sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM rows, range(61) AS t(d) GROUP BY ALL),
fitting AS (
  SELECT r.doc_id, r.n_bytes, r.h, p.*,
         row_number() OVER (PARTITION BY r.doc_id, r.h ORDER BY p.depth) AS k
  FROM rows r JOIN prefixes p ON p.prefix = r.h >> (60 - p.depth)::BIGINT
  WHERE p.shard_bytes <= {QUERY_BYTES} OR p.depth = 60)
SELECT doc_id, n_bytes, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard, depth, shard_bytes, shard_docs,
       shard_bytes > {QUERY_BYTES} AS oversize
FROM fitting WHERE k = 1
"""
