"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages and only the bag is labelled.  Every passage is encoded;
gated attention weighs the encodings, weights learned from the document labels; the
weighted sum is scored.  A document with one bad stretch among many good ones can so be
told from a clean one.

The model is fitted on a bounded sample of labelled documents (`Settings.train_docs` rows that
together have `Settings.train_passages` passages at most, each document with all of its own)
and scores every passage of every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from footings.llm.textarrays import _flags, blocks, code_points, word_bounds, word_hashes

STATS = 12                      # features of a passage besides its word counts
UPPER, ALNUM, DIGIT = _flags(str.isupper), _flags(str.isalnum), _flags(str.isdigit)


@dataclass(frozen=True)
class Settings:
    passage_words: int = 40
    buckets: int = 128          # hashed word counts of a passage
    hidden: int = 24            # size of an encoding
    gates: int = 12             # size of the attention layer
    train_docs: int = 4000      # bound of the sample that the model is fitted on
    train_passages: int = 400_000   # of all documents in that sample; a document has all of its passages or is left out
    epochs: int = 14
    rate: float = 0.01
    batch: int = 64
    seed: int = 7


def passages(texts: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and how many passages each text has (one at least)."""
    points, starts = code_points(texts)
    begin, end = word_bounds(points)
    words_of = np.searchsorted(begin, starts)
    n_words = np.diff(words_of)
    n_passages = np.maximum(1, -(-n_words // settings.passage_words))
    first = np.concatenate([[0], np.cumsum(n_passages)])[:-1]
    doc = np.repeat(np.arange(len(texts)), n_words)
    owner = first[doc] + (np.arange(len(begin)) - words_of[doc]) // settings.passage_words
    total = int(n_passages.sum())
    clipped = np.minimum(points, 0xFFFF)
    sums = [np.concatenate([[0], np.cumsum(flag[clipped])]) for flag in (UPPER, ALNUM, DIGIT)]
    size = (end - begin).astype(np.float64)
    upper, alnum, digit = (s[end] - s[begin] for s in sums)
    hashes = word_hashes(points, begin, end)
    bucket = (hashes % np.uint64(settings.buckets)).astype(np.int64)
    again = np.zeros(len(begin))
    if len(begin) > 1:
        again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    words = np.bincount(owner, minlength=total)
    per = np.maximum(words, 1)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, total) / per

    bag = np.bincount(owner * settings.buckets + bucket, minlength=total * settings.buckets)
    bag = bag.reshape(total, settings.buckets)
    marks = size - alnum
    stats = np.stack([
        mean(size), mean(size * size) ** 0.5, mean(upper / np.maximum(size, 1)), mean((upper == alnum) & (upper > 0)),
        mean(marks / np.maximum(size, 1)), mean(marks > 1), mean(alnum == 0), mean(digit / np.maximum(size, 1)),
        mean(again), (bag > 0).sum(1) / np.minimum(per, settings.buckets), bag.max(1) / per, words / settings.passage_words,
    ], axis=1)
    features = np.concatenate([stats, np.sqrt(bag / per[:, None])], axis=1)
    return features.astype(np.float32), n_passages


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Encoder, gated attention and scorer; parameters are small numpy arrays."""

    def __init__(self, inputs: int, settings: Settings, prior: float):
        self.settings, self.prior, self.fitted = settings, prior, False
        random = np.random.default_rng(settings.seed)

        def weights(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        h, g = settings.hidden, settings.gates
        self.center, self.scale = np.zeros(inputs, np.float32), np.ones(inputs, np.float32)
        self.p = {"W": weights(inputs, h), "b": np.zeros(h, np.float32), "V": weights(h, g), "U": weights(h, g),
                  "w": weights(g), "c": weights(h), "d": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict:
        """Scores of bags; `x` holds their standardised passages one after another, `sizes` how many each has."""
        p, starts = self.p, np.cumsum(sizes) - sizes
        bag = np.repeat(np.arange(len(sizes)), sizes)
        code = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(code @ p["V"]), _sigmoid(code @ p["U"])
        raw = (v * u) @ p["w"]
        weight = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        weight = weight / np.add.reduceat(weight, starts)[bag]
        z = np.add.reduceat(weight[:, None] * code, starts, axis=0)
        score = _sigmoid(z @ p["c"] + p["d"][0])
        return {"score": score, "bag": bag, "code": code, "v": v, "u": u, "weight": weight, "z": z}

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, sizes)
        bag, code, v, u, weight = f["bag"], f["code"], f["v"], f["u"], f["weight"]
        out = ((f["score"] - y) / len(y)).astype(np.float32)
        dz = out[:, None] * p["c"]
        dcode = weight[:, None] * dz[bag]
        dweight = (dz[bag] * code).sum(1)
        mean = np.add.reduceat(weight * dweight, np.cumsum(sizes) - sizes)
        draw = weight * (dweight - mean[bag])
        dgate = draw[:, None] * p["w"]
        dv, du = dgate * u * (1 - v * v), dgate * v * u * (1 - u)
        dcode += dv @ p["V"].T + du @ p["U"].T
        dpre = dcode * (1 - code * code)
        return {"W": x.T @ dpre, "b": dpre.sum(0), "V": code.T @ dv, "U": code.T @ du, "w": (v * u).T @ draw,
                "c": f["z"].T @ out, "d": out.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
        """Adam over shuffled batches of bags; with fewer than two classes the prior is all there is."""
        if len(set(labels.tolist())) < 2:
            return self
        every, s = np.concatenate(bags), self.settings
        self.center, self.scale = every.mean(0), every.std(0) + np.float32(1e-3)
        bags = [(b - self.center) / self.scale for b in bags]
        self.p["d"][0] = np.log(self.prior / (1 - self.prior))
        random = np.random.default_rng(s.seed)
        first = {k: np.zeros_like(a) for k, a in self.p.items()}
        second = {k: np.zeros_like(a) for k, a in self.p.items()}
        step, steps = 0, s.epochs * -(-len(bags) // s.batch)
        for _ in range(s.epochs):
            order = random.permutation(len(bags))
            for at in range(0, len(order), s.batch):
                chosen = order[at:at + s.batch]
                x = np.concatenate([bags[i] for i in chosen])
                grads = self.gradients(x, np.array([len(bags[i]) for i in chosen]), labels[chosen])
                step += 1
                rate = s.rate * (1 - step / (steps + 1))
                for name, grad in grads.items():
                    grad = grad + 1e-4 * self.p[name] * (name in "WVU")
                    first[name] = 0.9 * first[name] + 0.1 * grad
                    second[name] = 0.999 * second[name] + 0.001 * grad * grad
                    size = np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8
                    self.p[name] = self.p[name] - (rate * first[name] / (1 - 0.9 ** step) / size).astype(np.float32)
        self.fitted = True
        return self

    def scores(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(sizes), self.prior)
        return self.forward((x - self.center) / self.scale, sizes)["score"].astype(np.float64)


def held_out(key: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bags(sample: DataFrame, settings: Settings) -> DataFrame:
    """order, label, passages (how many) and x (their features) of the sample."""
    schema = StructType([StructField("order", LongType()), StructField("label", DoubleType()),
                         StructField("passages", LongType()), StructField("x", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                texts = [t or "" for t in part.column(2).to_pylist()]
                rows, many = [], []
                for lo, hi in blocks(texts):
                    x, sizes = passages(texts[lo:hi], settings)
                    rows += [bag.tobytes() for bag in np.split(x, np.cumsum(sizes)[:-1])]
                    many += sizes.tolist()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(many, pa.int64()), pa.array(rows, pa.binary())],
                                                 names=[f.name for f in schema])

    bags = sample.select("order", "label", "text").mapInArrow(run, schema)
    # The window holds `train_docs` rows at most.
    running = Window.orderBy("order", "label").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return bags.withColumn("_sum", F.sum("passages").over(running)).filter(F.col("_sum") <= settings.train_passages).drop("_sum")


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> AttentionModel:
    """Fit on labelled documents that are not held out.

    The sample is the `train_docs` labelled ids that come first by hash, as far as their passages
    number `train_passages` together; at most that many rows are broadcast to find their texts
    and come back as passage features.  An id with
    several labels counts by their mean; labels without a document or value are ignored.
    """
    chosen = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
              .withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(settings.train_docs))
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id", "order", "label").agg(F.min("text").alias("text")))
    rows = sorted(_bags(texts, settings).collect(), key=lambda r: r["order"])
    y = np.array([r["label"] for r in rows], np.float32)
    prior = float((y.sum() + 1) / (len(y) + 2))
    width = STATS + settings.buckets
    model = AttentionModel(width, settings, prior)
    return model.fit([np.frombuffer(r["x"], np.float32).reshape(-1, width) for r in rows], y)


def score(docs: DataFrame, model: AttentionModel, columns: list[str] | None = None) -> DataFrame:
    """`columns` of `docs` (all by default) with `score`: the probability of label 1.

    * Only the text is read for a score.  Null and empty texts are one passage without
      words and get a score too.
    * Rows are independent: repeated rows and null ids stay; an existing column `score`
      is replaced; an empty table gives no rows.  Nothing is shuffled.
    """
    kept = [c for c in (columns or docs.columns) if c != "score"]
    schema = StructType([*[docs.schema[c] for c in kept], StructField("score", DoubleType())])
    selected = docs.select(*[F.col(c) for c in kept], F.col("text").cast(StringType()).alias("_scored"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _scores(part.column(len(kept)), model)], names=schema.names)

    return selected.mapInArrow(run, schema)


def _scores(texts: pa.Array, model: AttentionModel) -> pa.Array:
    some = [t or "" for t in texts.to_pylist()]
    found = [model.scores(*passages(some[lo:hi], model.settings)) for lo, hi in blocks(some)]
    return pa.array(np.concatenate(found) if found else np.empty(0), pa.float64())


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(),
             columns: list[str] | None = None) -> DataFrame:
    """Train, then score every document: `columns` with held_out, score and predicted (score >= 0.5)."""
    scored = score(docs, train(docs, labels, settings), columns)
    return (scored.withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` that the classifier accepts (score 0.5 or more), columns as they are."""
    model = train(docs, labels, settings)
    place = docs.columns.index("text")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A text crosses once, in its row, and rows leave a few at a time.
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                rows = part.column(0)
                good = pc.greater_equal(_scores(rows.flatten()[place].cast(pa.string()), model), 0.5)
                yield pa.RecordBatch.from_arrays([rows.filter(good)], names=["row"])

    return packed.mapInArrow(run, packed.schema).select("row.*")
