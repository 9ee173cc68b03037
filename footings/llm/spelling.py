"""Spelling variants by a dictionary of trie-node pairs.

Every prefix of a word is a node of a trie, every suffix a node of the trie of reversed words, and
a word is a pair (prefix node, suffix node) at each of its positions.  Leaving one letter out gives
pairs around the skipped position.  Two words are one replacement apart exactly if they share a
pair around a skipped position; a word is another without one letter exactly if its pair around
the skipped position is a whole pair of the other.  Both are found by grouping equal pairs.

A node's number is the sum of 64-bit random numbers of (letter, place) along its path, places
counted from the start for prefixes and from the end for suffixes: no table of nodes is needed,
and a pair has 128 bits.

A group holds at most one word and its neighbours with one more letter at one place, so its size is
bounded by the alphabet.  Skipping either of two equal neighbouring letters gives the same
word; only the first of a run counts there, so every pair of near words is met exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.llm.tables import written
from footings.llm.textarrays import blocks, code_points, mixed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = "[^A-Za-zÀ-ÿ]+"
SKIPPED, FIRST_OF_RUN, WHOLE = 0, 1, 2       # what a pair of a word is


@dataclass(frozen=True)
class Settings:
    shortest: int = 7         # letters of a word
    least: int = 2            # occurrences of a word
    ratio: int = 10           # a form occurs so many times as often as its variant
    typo_every: int = 31      # one of so many (document, run) loses a letter


def variant(doc_id: Column, run: Column, settings: Settings = Settings()) -> Column:
    """`run` without one letter where the checksum of document and run says so (a null id: empty text)."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (check % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % settings.typo_every == 0, without).otherwise(run)


def word_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    runs = docs.select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), BETWEEN)).alias("run"))
    runs = runs.filter(F.length("run") >= settings.shortest)
    words = runs.select(variant(F.col("doc_id"), F.translate("run", UPPER, LOWER), settings).alias("word"))
    counts = words.filter(F.length("word") >= settings.shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= settings.least)


def node_pairs(words: DataFrame) -> DataFrame:
    """Per pair of a word: prefix, suffix (node numbers), kind, id, n."""
    names = ["prefix", "suffix", "kind", "id", "n"]

    def numbers(points: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
        return mixed(mixed(points.astype(np.uint64) + np.uint64(seed)) + place.astype(np.uint64))

    def before(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sums of the values before each place of a word, one more place than letters."""
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        places = np.repeat(first, size + 1) + _inside(size + 1)
        return total[places] - np.repeat(total[first], size + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in blocks(texts, 100_000):
                points, starts = code_points(texts[lo:hi])
                size = np.diff(starts) - 1
                letters = np.delete(points, starts[1:] - 1)        # without the line ends
                first = np.cumsum(size) - size
                inside, back = _inside(size), np.repeat(size, size) - 1 - _inside(size)
                prefix = before(numbers(letters, inside, 1), first, size)
                all_after = numbers(letters, back, 1 << 40)
                whole = np.repeat(np.add.reduceat(all_after, first) if len(first) else all_after[:0], size + 1)
                suffix = whole - before(all_after, first, size)
                cut = first + np.arange(len(first))                # places of a word in prefix and suffix
                last = np.zeros(len(prefix), bool)
                last[cut + size] = True
                same = np.zeros(len(letters), bool)
                same[1:] = (letters[1:] == letters[:-1]) & (inside[1:] > 0)
                owner, skipped = np.repeat(np.arange(lo, hi), size + 1), np.repeat(np.arange(lo, hi), size)
                kind = np.concatenate([np.where(same, SKIPPED, FIRST_OF_RUN), np.full(len(prefix), WHOLE)])
                owners = pa.array(np.concatenate([skipped, owner]))
                out = [np.concatenate([prefix[~last], prefix]), np.concatenate([suffix[np.flatnonzero(~last) + 1], suffix])]
                for at in range(0, len(kind), 100_000):
                    end = at + 100_000
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0][at:end].view(np.int64)), pa.array(out[1][at:end].view(np.int64)),
                         pa.array(kind[at:end].astype(np.int8)), batch.column(0).take(owners[at:end]),
                         batch.column(2).take(owners[at:end])], names=names)

    return words.select("id", "word", "n").mapInArrow(run, "prefix bigint, suffix bigint, kind tinyint, id bigint, n bigint")


def _inside(size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def _neighbours(pairs: DataFrame) -> DataFrame:
    """Per word with near words: id, n_near, and the most frequent of them (best.n, best.id; ties: smallest id)."""
    member = F.struct((-F.col("n")).alias("less"), "id", "kind")
    groups = pairs.groupBy("prefix", "suffix").agg(F.array_sort(F.collect_list(member)).alias("members")).filter(F.size("members") > 1)
    each = groups.select("members", F.explode("members").alias("m"))
    kind = F.col("m.kind")
    # Skipped letters meet each other; a whole word meets each run of letters once.
    near = F.filter("members", lambda x: (x["id"] != F.col("m.id")) & F.when(kind == WHOLE, x["kind"] == FIRST_OF_RUN).when(
        x["kind"] == WHOLE, kind == FIRST_OF_RUN).otherwise(True))
    met = each.select(F.col("m.id").alias("id"), near.alias("near")).filter(F.size("near") > 0)
    best = F.element_at("near", 1)
    return met.groupBy("id").agg(F.sum(F.size("near")).alias("n_near"), F.min(F.struct(best["less"].alias("less"), best["id"].alias("id"))).alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(id, root): where the forms of a word end; a form occurs several times as often, so ways are short."""
    steps = links.select(F.col("id").alias("root"), F.col("form").alias("_next"))
    found = links.select("id", F.col("form").alias("root"))
    while True:
        moved = found.join(steps, "root", "left").select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        table = written(moved, "spelling-roots")
        if table.filter("_moved").isEmpty():
            return table.select("id", "root")
        found = table.select("id", "root")


def spelling_variants(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    * Null texts hold no words; a null doc_id counts as an empty text in the checksum.
    * Repeated rows count each; ties of n go to the word that is first in code-point order.
    * Words may be of any length: the work of a word grows with its letters only.
    * Extra columns are ignored; an empty table gives no rows.
    """
    # Numbered in code-point order, so that the smaller id is the smaller word.
    ordered = word_counts(docs, settings).repartitionByRange("word").sortWithinPartitions("word")
    words = written(ordered.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    near = _neighbours(node_pairs(words))
    joined = words.join(near, "id", "left")
    form = F.when(-F.col("best.less") >= settings.ratio * F.col("n"), F.col("best.id"))
    table = written(joined.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), form.alias("form")),
                    "spelling-forms")
    roots = _roots(table.filter(F.col("form").isNotNull()).select("id", "form"))
    forms = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    ends = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    out = table.join(forms, "form", "left").join(ends, "id", "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed),
w AS (SELECT word, sum(times)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i::INT) AS a, substr(word, i::INT + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (SELECT x.word, y.word AS other, y.n FROM cut AS x JOIN cut AS y ON x.a = y.a AND x.b = y.b AND x.i = y.i WHERE x.word <> y.word
    UNION SELECT c.word, w.word, w.n FROM cut AS c JOIN w ON w.word = c.a || c.b
    UNION SELECT w.word, c.word, c.n FROM cut AS c JOIN w ON w.word = c.a || c.b),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM near GROUP BY 1),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
    CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n FROM w LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root FROM formed UNION ALL SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL),
ends AS (SELECT way.word, way.root FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
