"""Token counts, encoding and decoding against the library, on prose and on odd texts."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footings.llm import bpe
from footings.llm.tokencounts import PrefixCounter, longest_within, prefix_counts, tokens_of_prefix
from footings.llm.vocabulary import vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
POOL = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "é", "ß", "1", "½", "²", "Ⅷ", "_", "!", "...",
        "<|endoftext|>", "<|endof", "\x1c", "\x85", " ", "　", "日本", "𝔘", "\U0001D6A6", "՘", "🎉🎉",
        "token", "aaaaaaa", "-----", "\U0002CEA5", "‍", "\r\n", "THE", "lo", "ing", " I'LL"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(5)
    made = ["".join(rng.choices(POOL, k=rng.randint(0, 25))) for _ in range(400)]
    return made + ["", "a" * 3000, " " * 2000, "ab" * 1500, "日" * 900, "x" + "\n" * 500 + "y"]


def test_counts_at_every_prefix(library, odd_texts):
    counter = PrefixCounter(vocabulary(PATH))
    for text in odd_texts[:120]:
        expected = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert counter.at_prefixes(text).tolist() == expected, text


def test_totals_and_ids(library, odd_texts):
    counter, encoder = PrefixCounter(vocabulary(PATH)), bpe.Encoder(vocabulary(PATH))
    expected = [library.encode(t, add_special_tokens=False).ids for t in odd_texts]
    assert [counter.total(t) for t in odd_texts] == [len(e) for e in expected]
    assert [i.tolist() for i in encoder.encode(odd_texts)] == expected


def test_pair_check_agrees_with_merging():
    import numpy as np

    vocab, rng = vocabulary(PATH), random.Random(9)
    ids = list(vocab.ids.values())
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(1500)]
    pairs += [(a, b) for a, b in ((vocab.ids[x], vocab.ids[y]) for x in (b"th", b" t", b"a", b"aa", b"in") for y in (b"e", b"he", b"a", b"aa", b"g"))]
    expected = [vocab.merged(vocab.bytes[a] + vocab.bytes[b]) == [a, b] for a, b in pairs]
    assert [vocab.compatible(a, b) for a, b in pairs] == expected
    a, b = (np.array(x, np.int64) for x in zip(*pairs))
    assert vocab.compatible_pairs(a, b).tolist() == expected


def test_documents_match_the_library(library, spark, documents):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    ids = {k: library.encode(t, add_special_tokens=False).ids for k, t in texts.items()}
    counted = prefix_counts(documents, PATH, stored=False).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in counted} == {
        k: (len(t.encode()), len(ids[k])) for k, t in texts.items()}
    encoded = bpe.encode(documents, PATH)
    back = bpe.decode(encoded, PATH).collect()
    assert {r["doc_id"]: r["ids"] for r in back} == ids
    assert all(r["decoded"] == library.decode(ids[r["doc_id"]], skip_special_tokens=False) for r in back)


def test_stored_counts_answer_budgets(spark, library):
    text = "The 日本 quick'll brown fox<|endoftext|> jumps   over"
    df = prefix_counts(spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string"), PATH)
    row = df.select("doc_id", tokens_of_prefix(F.col("counts"), F.lit(9)).alias("n"),
                    longest_within(F.col("counts"), 5).alias("fit")).orderBy("doc_id").collect()
    count = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    assert row[0]["n"] == count[9]
    assert row[0]["fit"] == max(k for k, c in enumerate(count) if c <= 5)
    assert (row[1]["n"], row[1]["fit"]) == (0, 0)


def test_invalid_bytes_decode_like_the_library(spark, library):
    ids = [vocabulary(PATH).ids[b"\xe6"], 1000, 999_999]
    df = spark.createDataFrame([(1, ids), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(df, PATH).collect()}
    assert found == {1: library.decode(ids[:2], skip_special_tokens=False), 2: "", 3: ""}


def test_odd_rows(odd_documents, no_documents):
    counted = prefix_counts(odd_documents, PATH)
    rows = counted.collect()
    assert len(rows) == 11
    assert all(r["n_tokens"] == r["counts"][-1] for r in rows)
    assert sorted(r["n_bytes"] for r in rows)[:3] == [0, 0, 0]
    assert bpe.decode(bpe.encode(odd_documents, PATH), PATH).count() == 11
    assert prefix_counts(no_documents, PATH).count() == 0 and bpe.encode(no_documents, PATH).count() == 0
