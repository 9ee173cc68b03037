"""Benchmark passages in documents against a brute-force search."""

import random
import re

from footings.llm.decontamination import Settings, find_leaks, leak_digests, words_of
from pyspark.sql import functions as F

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    wins = set()
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        wins |= {(item, tuple(w[s:s + n])) for s in range(len(w) - n + 1) if n}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, win in wins:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found |= {item} - {None}
        out.append((doc, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=repr)


def found(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = find_leaks(d, b, Settings(**settings)).collect()
    for r in rows:
        assert all(x["end"] < y["start"] for x, y in zip(r["spans"], r["spans"][1:]))
    return sorted([(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in rows], key=repr)


def case(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)] + ["é", "Ünd", "日本", "the", "The"]

    def text(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    items = [(k, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 25]))) for k in range(12)]
    docs = []
    for k in range(40):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(items)[1].split()
            cut = rng.randint(0, 4)
            parts += [" ,- ".join(passage[cut:]), text(rng.randint(0, 5))]
        docs.append((k, " ".join(parts)))
    return docs, items


def test_against_brute_force(spark):
    docs, items = case(1)
    assert found(spark, docs, items) == brute(docs, items)
    # A tiny bitmap lets everything through, and nothing changes.
    assert found(spark, docs, items, bits=6, salts=2) == brute(docs, items)


def test_a_passage_in_a_third_of_all_rows(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{k}" for k in range(20))
    docs = [(k, " ".join(f"w{rng.randint(0, 99)}" for _ in range(30)) + (" " + passage if k % 3 == 0 else "")) for k in range(150)]
    items = [(7, passage), (8, passage), (9, "p3 p4"), (None, "w1 w2 w3")]
    assert found(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "one two three four"), (1, "seven eight"), (2, None), (3, ""), (4, "!!!"), (None, "word"), (5, "other text"), (6, "é" * 30_000)],
                                  "item_id bigint, text string").withColumn("node", F.lit(7)).withColumn("size", F.lit(7))
    got = leak_digests(odd_documents, items).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]))
    assert by[1] == [(8, 6, 1, True)] * 2 and by[5] == [(40_000, 40_000, 0, True)] and by[4] == [(1, 1, 1, True)]
    assert sorted(by[7]) == [(3, 0, 0, False), (4, 2, 1, True)] and by[2] == by[3] == by[6] == [(0, 0, 0, False)]
    assert len(got) == 11 and leak_digests(no_documents, items).count() == 0
    assert not any(r["contaminated"] for r in leak_digests(odd_documents, items.limit(0)).collect())


def test_words(one):
    assert one(words_of, "-Ab,cÉ 1x\tÀ--") == ["ab", "cÉ", "1x", "À"]
    assert one(words_of, "") == [] == one(words_of, " .. ")
