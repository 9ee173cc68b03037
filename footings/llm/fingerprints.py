"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases into phrases of phrases, and so on.  Where a
phrase begins is decided by deterministic coin tossing: a symbol's label comes from the
lowest bit in which it differs from its left neighbour, the same again on the labels until
few are left, and phrases begin at local maxima.  Only a few neighbours matter, so equal
substrings are parsed alike away from their ends, whatever precedes them.  A phrase is
named by a hash of the names in it; runs of one symbol are named by symbol and length.

The fingerprint is the sorted sample of the smallest names of phrases of some width.  Two
fingerprints tell which share of the phrases of two documents is common.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from footings.llm.textarrays import blocks, code_points, mixed, powers

SAMPLE = 128                  # names in a fingerprint
WIDTH = 24                    # code points a phrase must cover to count; less in short texts
SHORT = 16                    # a short text counts phrases from its length / SHORT on
BUCKET_DOCS = 1000            # documents that are sorted together
BUCKETS = 20_000              # bound of the table of bucket limits; larger buckets are streamed all the same
_RUN = np.uint64(0xD6E8FEB86659FD93)
_STEP = 0xC2B2AE3D27D4EB4F


def _toss_table() -> np.ndarray:
    """Label of (symbol, left neighbour) for symbols below 128."""
    x, left = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = x ^ left
    low = np.where(differ > 0, differ & -differ, 1)
    place = np.log2(low).astype(np.int64)
    return (2 * place + ((x >> place) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5, different for neighbours; `first` marks where a text begins."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = ~names[first]
    differ = names ^ left
    low = differ & (~differ + np.uint64(1))
    place = np.bitwise_count(low - np.uint64(1))
    labels = (2 * place + ((names & low) != 0)).astype(np.uint8)
    for _ in range(3):
        shifted = np.empty_like(labels)
        shifted[1:] = labels[:-1]
        shifted[first] = labels[first] ^ 1
        labels = _TOSS[labels.astype(np.uint16) * np.uint16(128) + shifted]
    return labels


def _phrases(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where phrases begin: at the start of every text and at local maxima of the labels."""
    first = np.empty(len(names), bool)
    first[0] = True
    np.not_equal(doc[1:], doc[:-1], out=first[1:])
    labels = _labels(names, np.flatnonzero(first)).astype(np.int8)
    begins = first.copy()
    if len(names) > 2:
        higher = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
        begins[1:-1] |= higher & ~first[2:] & ~first[1:-1]
    # A phrase has two symbols at least, unless its text has one.
    begins[1:] &= first[1:] | ~first[:-1]
    return begins


def parse(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Names of all phrases of all texts, level by level: (text, name, width in code points).

    A run counts like phrases that cover 1, 2, 4, … of its symbols, so that runs of unequal
    length are alike where they agree.
    """
    points, starts = code_points(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    inside = np.ones(len(points), bool)
    inside[starts[1:] - 1] = False
    names, doc = mixed(points[inside].astype(np.uint64)), doc[inside]
    width = np.ones(len(names), np.int64)
    while len(names):
        begins = np.empty(len(names), bool)
        begins[0] = True
        begins[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
        if not begins.all():
            at = np.flatnonzero(begins)
            size = np.diff(np.append(at, len(names)))
            symbol, owner, each = names[at], doc[at], width[at]
            runs = np.flatnonzero(size > 1)
            names = symbol.copy()
            names[runs] = mixed(symbol[runs] ^ (size[runs].astype(np.uint64) * _RUN))
            doc, width = owner, each * size
            half = 1
            while len(runs):
                yield owner[runs], mixed(symbol[runs] + np.uint64(half * _STEP % (1 << 64))), each[runs] * half
                half *= 2
                runs = runs[size[runs] >= half]
        begins = _phrases(names, doc)
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(names)))
        place = np.arange(len(names)) - np.repeat(at, size)
        names = mixed(np.add.reduceat(names * powers(int(size.max()))[place], at) + size.astype(np.uint64))
        width = np.add.reduceat(width, at)
        doc = doc[at]
        yield doc, names, width
        # A text that has become one phrase is done.
        alone = np.ones(len(doc), bool)
        alone[1:] &= doc[1:] != doc[:-1]
        alone[:-1] &= doc[1:] != doc[:-1]
        names, doc, width = names[~alone], doc[~alone], width[~alone]


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Per text the SAMPLE smallest 32-bit names of its wide phrases, ascending; empty for an empty text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    least = np.clip(sizes // SHORT, 2, WIDTH)
    found = [np.empty(0, np.uint64)]
    for doc, names, width in parse(texts):
        keep = width >= np.minimum(least, sizes)[doc]
        found.append((doc[keep].astype(np.uint64) << np.uint64(32)) | (mixed(names[keep]) >> np.uint64(32)))
    keys = np.unique(np.concatenate(found))
    limits = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    small = keys.astype(np.uint32)
    return [small[a:min(b, a + SAMPLE)] for a, b in zip(limits[:-1], limits[1:])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of phrases that two documents have in common (0 to 1), estimated from their samples.

    Among the smallest names of the union, the share found in both gives the resemblance r;
    common phrases over all phrases of both is then 2 r / (1 + r).  Two empty ones are alike.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)
    whole = len(a) < SAMPLE and len(b) < SAMPLE
    if not whole:
        union = union[:SAMPLE]
    both = len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True))
    r = both / len(union)
    return 2 * r / (1 + r)


def as_text(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<u4").tobytes()).decode()


def as_names(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_chars, fingerprint.  Null texts are empty; rows are independent; nothing is shuffled."""
    schema = StructType([StructField(key, docs.schema[key].dataType), StructField("n_chars", LongType()),
                         StructField("fingerprint", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = [f for lo, hi in blocks(texts) for f in fingerprints(texts[lo:hi])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(as_text, found), pa.string())],
                    names=[f.name for f in schema])

    return docs.select(key, text).mapInArrow(run, schema)


def with_successors(docs: DataFrame) -> DataFrame:
    """Rows (_bucket, _head, doc_id, text) sorted so that each document is followed by its successor.

    Successors go by descending doc_id (a null id comes last, equal ids by text); the first
    document follows the last.  Documents are dealt to buckets of ids with limits from an
    approximate quantile sketch, a pure function of the id; each bucket ends with a copy of
    the first document of the next one (`_head`).  Texts are shuffled once.
    """
    rank = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    ranked = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), rank.alias("_rank"))
    ids = docs.select(rank.alias("_rank"))
    count = ids.count()
    wanted = max(1, min(BUCKETS, math.ceil(count / BUCKET_DOCS)))
    inner = [k / wanted for k in range(1, wanted)]
    limits = sorted(set(ids.approxQuantile("_rank", inner, 0.25 / wanted))) if inner and count else []
    splits = [-math.inf, *(limits or [0.0]), math.inf]
    bucket = Bucketizer(splits=splits, inputCol="_value", outputCol="_place", handleInvalid="keep")

    def placed(df: DataFrame) -> DataFrame:
        valued = df.withColumn("_value", F.col("_rank").cast("double"))
        return bucket.transform(valued).withColumn("_bucket", (-F.col("_place")).cast("int")).drop("_place", "_value")

    tops = placed(ids).groupBy("_bucket").agg(F.max("_rank").alias("_rank")).orderBy("_bucket").collect()
    heads = [(tops[k - 1]["_bucket"], tops[k]["_rank"]) for k in range(len(tops))]
    table = docs.sparkSession.createDataFrame(heads, "_bucket int, _rank bigint")
    # At most BUCKETS rows: the ids that begin a bucket.
    first = (ranked.join(F.broadcast(table), "_rank").groupBy("_bucket", "_rank")
             .agg(F.min(F.struct("text", "doc_id")).alias("h")))
    head_rows = first.select("_bucket", F.lit(True).alias("_head"), "_rank", F.col("h.doc_id").alias("doc_id"),
                             F.col("h.text").alias("text"))
    rows = placed(ranked).select("_bucket", F.lit(False).alias("_head"), "_rank", "doc_id", "text")
    return (rows.unionByName(head_rows).repartition("_bucket")
            .sortWithinPartitions("_bucket", "_head", F.desc("_rank"), "text")
            .select("_bucket", "_head", "doc_id", "text"))


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of another (or all of it)."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and two likenesses.

    Columns: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited,
    near_next.  Null texts are empty; repeated rows follow each other; a single document
    is its own successor; extra columns are ignored; an empty table gives no rows.  A task
    streams its sorted rows and holds some hundred texts.
    """
    schema = StructType([
        docs.schema["doc_id"], StructField("n_chars", LongType()), StructField("edited_text", StringType()),
        StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
        StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                rows = held + list(zip(*(c.to_pylist() for c in part.columns)))
                own = [r[3] for r in rows]
                prints = [f for lo, hi in blocks(own) for f in fingerprints(own[lo:hi])]
                # A head only closes its bucket; the row after it begins another.
                pairs = [k for k in range(len(rows) - 1) if not rows[k][1]]
                changed = [edited(own[k], own[k + 1]) for k in pairs]
                theirs = [f for lo, hi in blocks(changed) for f in fingerprints(changed[lo:hi])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows[k][2] for k in pairs], batch.schema.field(2).type),
                    pa.array([len(own[k]) for k in pairs], pa.int64()), pa.array(changed, pa.string()),
                    pa.array([as_text(prints[k]) for k in pairs], pa.string()), pa.array(map(as_text, theirs), pa.string()),
                    pa.array([likeness(prints[k], f) for k, f in zip(pairs, theirs)], pa.float64()),
                    pa.array([likeness(prints[k], prints[k + 1]) for k in pairs], pa.float64())],
                    names=[f.name for f in schema])
                held = rows[-1:]

    return with_successors(docs).mapInArrow(run, schema)


def fingerprint_digests(docs: DataFrame) -> DataFrame:
    compared = compare_with_edits(docs)
    return compared.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
                           "edited_fingerprint", "near_edited", "near_next")
