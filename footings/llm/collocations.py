"""Collocations per language, counted with an FM-index per shard over word ids.

1. Tasks cut their texts into words and write shards of one language each: a dictionary with
   counts and the sequence of word ids.  Counts are summed across shards; words below the
   threshold can be in no candidate and become breaks.
2. Every shard is turned into an FM-index: the Burrows-Wheeler transform of its ids, with
   suffixes in order of their first four words, as no phrase is longer.
3. A phrase is an interval of that index.  All intervals of one length are extended to the left
   at once by the last-to-first mapping; the interval of a longer phrase lies inside that of the
   phrase without its last word, so both one-word-shorter parts of it are known (the left and the
   right extension of each other) and a phrase is followed only if both can be frequent.
4. Counts of pairs are summed across shards; a bitmap of fixed size of the frequent ones tells
   shards which longer phrases to count, and those are summed in turn.  False hits of the bitmap
   only add rows: sums decide.

What is added up, joined and ranked are rows of ids; words come back at the end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footings.llm.tables import removed, written
from footings.llm.textarrays import mixed

BREAK = "\n"                  # no word holds one
TEXT_BYTES = 4_000_000        # of texts cut into words at a time


@dataclass(frozen=True)
class Settings:
    least: int = 30           # occurrences of a candidate
    longest: int = 4          # words of a candidate
    absorbed: int = 80        # per cent of a phrase's occurrences inside one longer candidate that drop it
    top: int = 2000           # phrases reported per language
    shard_words: int = 1_000_000
    bits: int = 25            # the bitmap of frequent pairs has 2**bits bits


def cut_texts(texts: pa.Array) -> pa.Array:
    """The words of all texts in order, with a break after every piece and every text."""
    low = pc.replace_substring_regex(pc.ascii_lower(texts), pattern="[.,;:!?\\x0A-\\x0D]+", replacement=" \n ")
    low = pc.binary_join_element_wise(pc.replace_substring(low, "\t", " "), pa.scalar("\n", low.type), pa.scalar(" ", low.type))
    words = pc.split_pattern(low, " ").flatten()
    return words.filter(pc.not_equal(words, ""))


def _encoded(parts: list[pa.Array]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words by falling frequency, their counts, and the sequence of ids (from 1; 0 is a break)."""
    coded = pa.concat_arrays(parts).dictionary_encode()
    words, ids = coded.dictionary, coded.indices.to_numpy()
    counts = np.bincount(ids, minlength=len(words))
    solid = pc.not_equal(words, BREAK).to_numpy(zero_copy_only=False)
    order = np.argsort(-np.where(solid, counts, -1), kind="stable")[:int(solid.sum())]
    new = np.zeros(len(words), np.int32)
    new[order] = np.arange(1, len(order) + 1)
    return words.take(pa.array(order)), counts[order], new[ids]


def packed(numbers: np.ndarray) -> bytes:
    """Little-endian int32 numbers, byte planes one after another, compressed; the length first."""
    planes = np.ascontiguousarray(numbers.astype("<i4")).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _shards(docs: DataFrame, settings: Settings) -> DataFrame:
    """Rows (shard, lang, words, counts, ids): dictionary and sequence of word ids."""
    schema = "shard string, lang string, words array<string>, counts array<bigint>, ids binary"

    def row(lang: str, parts: list[pa.Array]) -> pa.RecordBatch:
        words, counts, ids = _encoded(parts)
        ends = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.array([lang]), pa.ListArray.from_arrays(ends, words.cast(pa.string())),
             pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())), pa.array([packed(ids)], pa.binary())],
            names=["shard", "lang", "words", "counts", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        for batch in batches:
            texts = batch.column(1)
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            block = np.cumsum(size) // TEXT_BYTES
            for lo, hi in zip(*_runs(block)):
                langs, some = batch.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo)
                for lang in pc.unique(langs).to_pylist():
                    parts = held.setdefault(lang, [])
                    parts.append(cut_texts(some.filter(pc.equal(langs, lang))))
                    if sum(map(len, parts)) >= settings.shard_words:
                        yield row(lang, held.pop(lang))
        for lang, parts in held.items():
            yield row(lang, parts)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the runs of equal neighbours."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return starts, np.append(starts[1:], len(values))


def _sorted_places(values: np.ndarray) -> np.ndarray:
    """A stable argsort of non-negative numbers below 2**31."""
    return np.sort(values.astype(np.int64) << 32 | np.arange(len(values))) & 0xFFFFFFFF


def transform(ids: np.ndarray) -> np.ndarray:
    """The Burrows-Wheeler transform of a sequence that ends in a break, by the first four ids of each rotation."""
    pair = ids.astype(np.int64) << 32 | np.roll(ids, -1)
    pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    pair <<= 32
    pair |= np.roll(pair >> 32, -2)
    four = np.argsort(pair)
    return ids[four - 1]


def phrases(last: np.ndarray, longest: int, followed=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 2 on: (phrases as rows of ids, counts), from the transform of a shard.

    `followed(first, second)` says which pairs of ids longer phrases may hold.
    """
    back = _sorted_places(last)              # the row that a row's suffix without its first id has
    first = last[back]
    label, good = first, first > 0           # interval of the phrase at each row, in row order
    column = [first]
    for length in range(2, longest + 1):
        column.append(column[-1][back])
        behind = label[back]
        good = good & good[back]
        fresh = np.ones(len(last), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (behind[1:] != behind[:-1])
        starts = np.flatnonzero(fresh)
        counts = np.diff(np.append(starts, len(last)))
        kept = good[starts]
        starts, counts = starts[kept], counts[kept]
        yield np.stack([c[starts] for c in column], 1), counts
        if length == 2 and followed is not None and longest > 2:
            likely = np.zeros(len(last), bool)
            likely[starts] = followed(column[0][starts], column[1][starts])
            good = np.repeat(likely[np.flatnonzero(fresh)], np.diff(np.append(np.flatnonzero(fresh), len(last))))
        label = np.cumsum(fresh, dtype=np.int32)


def _indexes(shards: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows (known, last): global ids of a shard's frequent words, and its transform over their places."""
    schema = "known array<bigint>, last binary"
    entry = F.posexplode("words").alias("place", "word")
    known = (shards.select("shard", "lang", entry).join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
             .groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("known")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                places, known = (part.to_numpy() for part in batch.column(1).slice(k, 1).flatten().flatten())
                new = np.zeros(int(places.max()) + 2, np.int32)
                new[places + 1] = np.arange(1, len(places) + 1)
                ids = unpacked(batch.column(0)[k].as_py())
                ids = np.where(ids < len(new), new[np.minimum(ids, len(new) - 1)], 0)
                solid = ids > 0
                ids = ids[solid | np.append(True, solid[:-1])[:len(ids)]]      # one break in a row
                ids = np.append(ids, np.int32(0)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), pa.array(known)),
                     pa.array([packed(transform(ids))], pa.binary())], names=["known", "last"])

    return shards.select("shard", "ids").join(known, "shard").select("ids", "known").mapInArrow(run, schema)


def _bit(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(mixed(first.astype(np.uint64)) + second.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _bitmap(pairs: DataFrame, bits: int) -> np.ndarray:
    """Which of 2**bits cells a frequent pair falls into; what comes to the driver is bounded by that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bit(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(mask)], names=["cell", "mask"])

    cells = pairs.select("id1", "id2").mapInArrow(run, "cell bigint, mask bigint")
    found = cells.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("cell").to_numpy()] = found.column("mask").to_numpy()
    return out.view(np.uint64)


def _counted(indexes: DataFrame, low: int, high: int, settings: Settings, bitmap=None) -> DataFrame:
    """Phrases of `low` to `high` words with their sums over all shards, from the threshold on."""
    names = [f"id{k}" for k in range(1, high + 1)]
    spread = None if bitmap is None else indexes.sparkSession.sparkContext.broadcast(bitmap)
    bits = settings.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                known = np.concatenate([[-1], batch.column(0)[k].values.to_numpy()]).astype(np.int64)

                def followed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
                    at = _bit(known[first], known[second], bits)
                    return spread.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) > 0

                for found, counts in phrases(unpacked(batch.column(1)[k].as_py()), high, None if spread is None else followed):
                    if found.shape[1] >= low and len(found):
                        for at in range(0, len(found), 200_000):
                            ids, some = known[found[at:at + 200_000]], counts[at:at + 200_000]
                            none = pa.nulls(len(ids), pa.int64())
                            columns = [pa.array(np.ascontiguousarray(ids[:, c])) if c < ids.shape[1] else none for c in range(high)]
                            yield pa.RecordBatch.from_arrays([*columns, pa.array(some.astype(np.int64))], names=[*names, "a"])

    rows = indexes.mapInArrow(run, ", ".join(f"{c} bigint" for c in [*names, "a"]))
    return rows.groupBy(*names).agg(F.sum("a").alias("a")).filter(F.col("a") >= settings.least)


def _score(a: str, left: str, right: str) -> Column:
    """floor(2000000 * a / (left + right)) in decimals, as products may pass 64 bits."""
    return F.expr(f"(CAST({a} AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) div CAST({left} + {right} AS DECIMAL(20,0))")


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    * Null texts are empty, a null language is `und`; repeated rows count each.
    * A phrase never crosses a piece, a text or a language.
    * Ties of score go by occurrences, then by the phrase in byte order; of equal cuts the first counts.
    * Extra columns are ignored; an empty table gives no rows.
    """
    shards = written(_shards(docs, settings), "collocation-shards", compression="zstd")
    entries = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    words = entries.groupBy("lang", F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("f"))
    vocabulary = words.filter(F.col("f") >= settings.least).withColumn("id", F.monotonically_increasing_id())
    vocabulary = written(vocabulary, "collocation-words")
    per_shard = F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x)
    totals = written(shards.groupBy("lang").agg(F.sum(per_shard).alias("n")), "collocation-totals")
    indexes = written(_indexes(shards, vocabulary), "collocation-indexes")
    removed(shards)
    counted = {2: written(_counted(indexes, 2, 2, settings), "collocation-pairs")}
    longer = written(_counted(indexes, 3, settings.longest, settings, _bitmap(counted[2], settings.bits)), "collocation-longer")
    removed(indexes)
    for size in range(3, settings.longest + 1):
        ids = [f"id{k}" for k in range(1, size + 1)]
        last = F.col(f"id{size + 1}").isNull() if size < settings.longest else F.lit(True)
        counted[size] = longer.filter(F.col(f"id{size}").isNotNull() & last).select(*ids, "a")
    counted[1] = vocabulary.select(F.col("id").alias("id1"), F.col("f").alias("a"))
    found = [_kept(size, counted, settings) for size in range(2, settings.longest + 1)]
    scored = found[0]
    for one in found[1:]:
        scored = scored.unionByName(one, allowMissingColumns=True)
    named = scored.join(vocabulary.select(F.col("id").alias("id1"), "lang", F.col("word").alias("word1")), "id1")
    # Ties stay until the words are known; both filters hold before their shuffles, too.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    named = named.withColumn("rank", F.rank().over(best)).filter(F.col("rank") <= settings.top)
    for k in range(2, settings.longest + 1):
        word = vocabulary.select(F.col("id").alias(f"id{k}"), F.col("word").alias(f"word{k}"))
        named = named.join(word, f"id{k}", "left")
    phrase = F.concat_ws(" ", *[f"word{k}" for k in range(1, settings.longest + 1)])
    ranked = named.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(best.orderBy(
        F.desc("score"), F.desc("a"), "phrase")).cast("bigint")).filter(F.col("rank") <= settings.top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _kept(size: int, counted: dict[int, DataFrame], settings: Settings) -> DataFrame:
    """Candidates of `size` words that no longer one absorbs, with the cut that scores lowest."""
    ids = [f"id{k}" for k in range(1, size + 1)]
    out = counted[size]
    around = None
    for wider in range(size + 1, settings.longest + 1):
        for start in range(1, wider - size + 2):
            part = counted[wider].select(*[F.col(f"id{start + k}").alias(ids[k]) for k in range(size)], F.col("a").alias("_wider"))
            around = part if around is None else around.unionByName(part)
    if around is not None:
        most = around.groupBy(*ids).agg(F.max("_wider").alias("_wider"))
        out = out.join(most, ids, "left").filter(
            F.col("_wider").isNull() | (100 * F.col("_wider") < settings.absorbed * F.col("a"))).drop("_wider")
    cuts = []
    for low, high in sorted({(at, size) for at in range(1, size)}):
        for name, (begin, end) in (("l", (1, low)), ("r", (low + 1, high))):
            part = counted[end - begin + 1]
            renamed = part.select(*[F.col(f"id{k - begin + 1}").alias(f"id{k}") for k in range(begin, end + 1)],
                                  F.col("a").alias(f"{name}{low}"))
            out = out.join(renamed, [f"id{k}" for k in range(begin, end + 1)])
        cuts.append(F.struct(_score("a", f"l{low}", f"r{low}").alias("score"), F.lit(low).alias("cut"),
                             F.col(f"l{low}").alias("l"), F.col(f"r{low}").alias("r")))
    lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return out.select(*ids, "a", lowest.alias("_cut")).select(*ids, "a", "_cut.l", "_cut.r", "_cut.score")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
t AS (SELECT lang, pid, unnest(w) AS w1, unnest(range(len(w))) AS s FROM p),
g AS (SELECT lang, w1, lead(w1, 1) OVER x AS w2, lead(w1, 2) OVER x AS w3, lead(w1, 3) OVER x AS w4
    FROM t WINDOW x AS (PARTITION BY pid ORDER BY s)),
f AS (SELECT lang, [w1] AS ws, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2], count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM g WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
parts AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM f WHERE len(ws) > 1),
cuts AS (SELECT p.lang, p.ws, p.a, k, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * p.a) // (l.a + r.a) AS BIGINT) AS score
    FROM (SELECT *, ws[1:k] AS lw, ws[k + 1:] AS rw FROM parts) AS p
    JOIN f AS l ON l.lang = p.lang AND l.ws = p.lw JOIN f AS r ON r.lang = p.lang AND r.ws = p.rw),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, ws[i:i + m - 1] AS ws, max(a) AS wider
    FROM (SELECT lang, ws, a, m, unnest(range(1, len(ws) - m + 2)) AS i
        FROM (SELECT lang, ws, a, unnest(range(2, len(ws))) AS m FROM f WHERE len(ws) > 2)) GROUP BY ALL),
kept AS (SELECT b.*, array_to_string(b.ws, ' ') AS phrase FROM best AS b LEFT JOIN inner_parts AS i USING (lang, ws)
    WHERE wider IS NULL OR 100 * wider < 80 * a),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""
