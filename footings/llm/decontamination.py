"""Passages of a benchmark in documents, by a prefix-filtered join of shingles.

Words are runs of ASCII letters, digits and all characters beyond ASCII; only A-Z are lower-cased.
An item is cut into windows of ten consecutive words (an item of fewer words is one window),
and each window is a set of shingles of three words.  A document can hold a window only if it
holds every shingle of it, so the necessary prefix of a window is its one rarest shingle:

1. every position of every document whose shingle occurs in the benchmark at all is kept, with
   the words around it that a window over it could cover; a bitmap of fixed size, made from the
   benchmark, lets nearly all other positions go inside the scan;
2. shingles are counted over all documents, and each window is joined on its rarest one;
3. a window over the position must fit into the text (positional and length bounds), and its
   words must be exactly those around the position.

Everything is a DataFrame expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.llm.tables import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Settings:
    window: int = 10          # words of a window
    shingle: int = 3          # words of a shingle (fewer only for items of fewer words)
    bits: int = 20            # the bitmap has 2**bits bits, whatever the size of the benchmark
    salts: int = 16           # tasks that one shingle's positions are dealt to


def words_of(text: Column) -> Column:
    """The words of `text`, with A-Z in lower case; a text that starts or ends between words has empty pieces there."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, BETWEEN), "")


def shingle_at(words: Column, at: Column, size: int) -> Column:
    """The number of the `size` words from position `at` on, null beyond the end."""
    return F.when(at + size <= F.size(words), F.xxhash64(F.lit(size), *[words[at + k] for k in range(size)]))


def windows(benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per window of an item: item_id, window (its words, joined), n (how many), words."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("_all"))
    n = F.least(F.size("_all"), F.lit(settings.window))
    starts = items.filter(F.size("_all") > 0).select(
        "item_id", "_all", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("_all") - n + 1)).alias("_start"))
    words = starts.select("item_id", "n", F.slice("_all", F.col("_start"), F.col("n")).alias("words"))
    return words.select("item_id", F.array_join("words", " ").alias("window"), "n", "words")


def _shingles(wins: DataFrame, settings: Settings) -> DataFrame:
    """(window, n, size, offset, token) of the distinct windows."""
    sized = wins.dropDuplicates(["window"]).withColumn("size", F.least("n", F.lit(settings.shingle)))
    at = sized.select("window", "n", "size", "words", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("size"))).alias("offset"))
    token = F.coalesce(*[F.when(F.col("size") == s, shingle_at(F.col("words"), F.col("offset"), s))
                         for s in range(1, settings.shingle + 1)])
    return at.select("window", "n", "size", "offset", token.alias("token"))


def _bitmap(tokens: DataFrame, bits: int) -> DataFrame:
    """One row: an array of 2**bits / 64 numbers, in which the bits of all tokens are set."""
    cells = 1 << (bits - 6)
    cell = F.shiftrightunsigned("token", 6).bitwiseAND(F.lit(cells - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("token").bitwiseAND(F.lit(63)).cast("int"))
    filled = tokens.select(cell.alias("cell"), mask.alias("mask"))
    every = tokens.sparkSession.range(cells).select(F.col("id").alias("cell"), F.lit(0).cast("bigint").alias("mask"))
    cells_set = filled.unionByName(every).groupBy("cell").agg(F.bit_or("mask").alias("mask"))
    # A group of fixed size: one number per cell.
    return cells_set.agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "mask"))), lambda x: x["mask"]).alias("bits"))


def _is_set(bitmap: Column, token: Column, bits: int) -> Column:
    cell = F.shiftrightunsigned(token, 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1)).cast("int")
    bit = F.call_function("shiftright", bitmap[cell], token.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
    return F.coalesce(bit == 1, F.lit(False))


def _positions(docs: DataFrame, shingles: DataFrame, settings: Settings) -> DataFrame:
    """One row per document (`head`) and per position that may start a shingle of the benchmark."""
    # At most as many sizes as a shingle has words.
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())
    bitmap = _bitmap(shingles.select("token").distinct(), settings.bits).scalar()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.unhex(F.md5(text)).alias("node"), words_of(F.col("text")).alias("_words"))
    rows = rows.select("doc_id", "node", "_words", F.posexplode_outer("_words").alias("pos", "_word"))
    words, pos = F.col("_words"), F.col("pos")
    tokens = [shingle_at(words, pos, s) for s in sizes]
    found = [_is_set(bitmap, token, settings.bits) for token in tokens]
    head = F.coalesce(pos == 0, F.lit(True))
    any_found = F.lit(False)
    for one in found:
        any_found = any_found | one
    first = F.greatest(pos - settings.window + 1, F.lit(0))
    # Code is generated for all of this in one stage, so that only these narrow rows are ever put down, whatever
    # the length of a text: an expression that is not would make its rows carry all words of the text.
    return rows.filter(head | any_found).select(
        F.when(head, F.col("doc_id")).alias("doc_id"), "node", head.alias("head"),
        F.when(head, F.size(words)).cast("bigint").alias("n_words"), "pos",
        (pos - first).alias("before"), F.when(any_found, F.slice(words, first + 1, F.lit(2 * settings.window))).alias("around"),
        *[F.when(one, token).alias(f"token{k}") for k, (token, one) in enumerate(zip(tokens, found))])


def _rarest(shingles: DataFrame, places: DataFrame, settings: Settings) -> DataFrame:
    """Per window its rarest shingle; windows with a shingle that no document has are left out."""
    known = shingles.select("token").distinct()
    counts = places.groupBy("token").agg(F.count("*").alias("count")).join(known, "token", "left_semi")
    ranked = shingles.join(counts, "token", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    rare = ranked.groupBy("window", "n").agg(F.min(F.struct("count", "token", "offset")).alias("rare")).filter("rare.count > 0")
    return rare.select("window", "n", F.col("rare.token").alias("token"), F.col("rare.offset").alias("offset"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, spans (merged [start, end) word ranges inside windows), items (sorted ids).

    * Null texts have no words, in documents and items; such items have no windows.
    * Items of equal ids count once.  An item without an id marks its words, but is not listed.
    * A window that occurs several times, or in several items, marks all its places for all of them.
    * Repeated rows each get their own result; extra columns are ignored; empty tables give no rows,
      an empty benchmark no spans.
    """
    wins = written(windows(benchmark, settings), "benchmark-windows")
    shingles = written(_shingles(wins, settings), "benchmark-shingles")
    table = written(_positions(docs, shingles, settings), "benchmark-positions")
    tokens = F.array(F.lit(None).cast("bigint"), *[F.col(c) for c in table.columns if c.startswith("token")])
    places = table.filter(F.col("around").isNotNull()).select(
        "node", "pos", "before", "around", F.explode(tokens).alias("token")).filter(F.col("token").isNotNull())
    # One shingle may be in a third of all documents: its positions are dealt to several tasks.
    salt = F.pmod(F.xxhash64("node", "pos"), F.lit(settings.salts)).cast("int")
    rare = _rarest(shingles, places, settings).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))))
    start = F.col("before") - F.col("offset")
    met = places.withColumn("salt", salt).join(rare, ["token", "salt"]).filter(
        (start >= 0) & (start + F.col("n") <= F.size("around")))
    same = F.array_join(F.slice("around", start + 1, F.col("n")), " ") == F.col("window")
    hits = written(met.filter(same).select("node", (F.col("pos") - F.col("offset")).cast("bigint").alias("start"), "n", "window"),
                   "benchmark-hits")
    ranges = hits.groupBy("node").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("ranges"))
    listed = (hits.select("node", "window").distinct().join(wins.select("window", "item_id").distinct(), "window")
              .groupBy("node").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    found = ranges.select("node", _merged(F.col("ranges")).alias("spans")).join(listed, "node", "left")
    rows = table.filter("head").select("doc_id", "node", "n_words").join(found, "node", "left")
    none = "array<struct<start:bigint,end:bigint>>"
    return rows.select("doc_id", "n_words", F.coalesce("spans", F.array().cast(none)).alias("spans"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _merged(ranges: Column) -> Column:
    """Sorted ranges with those that touch or overlap joined: a range starts where none before reaches."""
    kind = "struct<open:struct<start:bigint,end:bigint>,done:array<struct<start:bigint,end:bigint>>>"
    start = F.struct(F.lit(None).cast("struct<start:bigint,end:bigint>").alias("open"),
                     F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done")).cast(kind)

    def step(state: Column, x: Column) -> Column:
        span = state["open"]
        longer = F.struct(span["start"].alias("start"), F.greatest(span["end"], x["end"]).alias("end"))
        return F.when(span.isNull(), F.struct(x.alias("open"), state["done"].alias("done")).cast(kind)).when(
            x["start"] <= span["end"], F.struct(longer.alias("open"), state["done"].alias("done")).cast(kind)).otherwise(
            F.struct(x.alias("open"), F.concat(state["done"], F.array(span)).alias("done")).cast(kind))

    return F.aggregate(ranges, start, step, lambda s: F.concat(s["done"], F.array(s["open"])))


def leak_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_leaks(docs, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
iw AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM iw),
p AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS s FROM d),
ahead AS (SELECT rid, s, list(word) OVER (PARTITION BY rid ORDER BY s ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM p),
shown AS (SELECT rid, s, n, array_to_string(l[1:n], ' ') AS t FROM ahead, (SELECT DISTINCT n FROM win) AS sizes WHERE n <= len(l)),
hits AS (SELECT DISTINCT rid, s, n, item_id FROM shown JOIN win USING (n, t)),
spots AS (SELECT rid, count(DISTINCT spot) AS n_hit
    FROM (SELECT rid, unnest(range(s, s + n)) AS spot FROM (SELECT DISTINCT rid, s, n FROM hits)) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN spots USING (rid) LEFT JOIN items USING (rid)
"""
