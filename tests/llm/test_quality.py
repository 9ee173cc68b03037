"""The classifier: held-out accuracy, gradients, and odd rows."""

import numpy as np
from pyspark.sql import functions as F

from footings.llm import quality
from footings.llm.quality import AttentionModel, Settings, classify, held_out, keep_good, passages


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    rows = classify(docs, labels, columns=["doc_id"]).join(labels, "doc_id").filter("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in rows]
    bad = [r["predicted"] == 0 for r in rows if r["quality"] == 0]
    assert np.mean(right) > 0.95 and np.mean(bad) > 0.85
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    settings = Settings(buckets=4, hidden=5, gates=3)
    model = AttentionModel(6, settings, 0.5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, sizes, y = rng.standard_normal((9, 6)), np.array([4, 1, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = model.forward(x, sizes)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    found = model.gradients(x, sizes, y)
    for name, value in model.p.items():
        flat = value.ravel()
        for k in range(0, flat.size, 3):
            kept = flat[k]
            flat[k] = kept + 1e-5
            up = loss()
            flat[k] = kept - 1e-5
            down = loss()
            flat[k] = kept
            assert abs((up - down) / 2e-5 - found[name].ravel()[k]) < 1e-4, name


def test_held_out_rows_by_crc32(spark):
    import zlib

    rows = spark.range(300).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_passages_do_not_depend_on_company():
    texts = ["one two three " * 50, "", "X" * 5000, "a b"]
    together, sizes = passages(texts, Settings())
    apart = [passages([t], Settings()) for t in texts]
    assert sizes.tolist() == [n for _, s in apart for n in s.tolist()] == [4, 1, 1, 1]
    assert np.allclose(together, np.concatenate([x for x, _ in apart]))


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (5, 1), (None, 1), (6, None), (1, 0), (99, 1)],
                                   "doc_id bigint, quality int")
    rows = classify(odd_documents, labels, columns=["doc_id", "size"]).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 and r["size"] == 7 for r in rows)
    kept = keep_good(odd_documents, labels)
    assert kept.columns == odd_documents.columns and kept.count() <= 11
    assert classify(no_documents, labels).count() == 0
    # Without labels of both kinds the prior is all there is.
    none = labels.limit(0)
    assert {r["score"] for r in classify(odd_documents, none, columns=["doc_id"]).collect()} == {0.5}
    assert quality.keep_good(no_documents, none).count() == 0
