"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

from footings.llm.spelling import Settings, node_pairs, spelling_variants


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, least=2):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= least}
    others = {w: [o for o in n if near(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(others[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling_variants(df).collect())


def docs_of(words, seed=5):
    rng = random.Random(seed)
    flat = [w for w, times in words for _ in range(times)]
    rng.shuffle(flat)
    return [(k, rng.choice([" ", "-", "1"]).join(flat[at:at + 12])) for k, at in enumerate(range(0, len(flat), 12))]


def test_against_all_pairs(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(60)]
    words = [(w, rng.choice([1, 2, 3, 40])) for w in base]
    for w in base[:40]:
        k = rng.randint(0, len(w) - 1)
        words.append((rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcÉ") + w[k:], w[:k] + "x" + w[k + 1:]]), rng.choice([2, 3])))
    docs = docs_of(words)
    got = found(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4))
    assert got == brute(docs) and sum(r[4] for r in got) > 50 and any(r[1] for r in got)


def test_chains_runs_and_ties(spark):
    # A chain of three forms, letters in runs, two forms of equal n, and neighbours at the ends of words.
    words = [("aabbccd", 2000), ("aabbcccd", 150), ("aabbccccd", 12), ("Aabbcccccd", 1), ("aabbcccccd", 1),
             ("zzzzzzz", 30), ("zzzzzzzz", 3), ("kkkkkka", 25), ("kkkkkkb", 25), ("kkkkkkc", 2), ("bkkkkkkc", 2), ("éaaaaaa", 2), ("Éaaaaaa", 2)]
    docs = docs_of(words)
    got = found(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert got == brute(docs)
    assert any(r[1] and r[1] != r[2] for r in got)


def test_one_word_in_a_third_of_all_rows(spark):
    docs = docs_of([("somethinglong", 400), ("somethinlong", 4)] + [(f"variant{c}" + "x" * 5, 2) for c in "abcdefghij"])
    assert found(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)) == brute(docs)


def test_long_words_take_linear_work(spark):
    words = spark.createDataFrame([(1, "ab" * 50_000, 2), (2, "ab" * 50_000 + "c", 3), (3, "é" * 7, 2)], "id bigint, word string, n bigint")
    rows = node_pairs(words)
    assert rows.count() == 2 * 100_000 + 1 + 2 * 100_001 + 1 + 15
    assert rows.groupBy("prefix", "suffix").count().filter("count > 1").count() == 1


def test_odd_rows(odd_documents, no_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert found(odd_documents) == brute(docs)
    assert found(no_documents) == [] and found(odd_documents.filter("text is null")) == []
    assert Settings().least == 2
