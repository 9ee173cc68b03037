"""Collocations against counting all phrases; the index of a shard against its sequence."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from footings.llm.collocations import Settings, _score, collocations, cut_texts, packed, phrases, transform, unpacked


def brute(docs, least=30, top=2000, longest=4):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, found in counts.items():
        f = {p: a for p, a in found.items() if a >= least}
        rows = []
        for p, a in f.items():
            if len(p) == 1:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in f.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -score) for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def found(df, **settings):
    return sorted(tuple(r) for r in collocations(df, Settings(**settings)).collect())


def case(seed, docs):
    rng = random.Random(seed)
    words = ["a", "B", "c", "d|", "é", "É", "\x00", "x\x1f", "日本", "the", "The"] + [f"w{k}" for k in range(25)]
    out = []
    for _ in range(docs):
        text = ""
        for _ in range(rng.randint(0, 60)):
            if rng.random() < 0.1:
                text += rng.choice(["new york city", "New York", "in the new york city"]) + rng.choice([" ", ", "])
            text += rng.choice(words) + rng.choice([" "] * 6 + ["\t", "  ", ".", ", ", "\n", "\x0b", "?!"])
        out.append((rng.choice(["en", "en", "de", None]), text))
    return out


def test_against_brute_force(spark):
    docs = case(3, 300)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    assert found(df, least=5) == brute(docs, 5)
    # Shards of few words, and a bitmap that lets everything through.
    assert found(df, least=5, shard_words=200, bits=6, top=20) == brute(docs, 5, 20)


def test_one_text_in_a_third_of_all_rows(spark):
    docs = case(4, 60) + [("en", "so it goes. so it goes again")] * 40
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    assert found(df, least=8, shard_words=150) == brute(docs, 8)


def test_index_of_a_shard():
    ids = np.append(np.random.default_rng(1).integers(0, 5, 400), 0).astype(np.int32)
    last = transform(ids)
    assert (unpacked(packed(last)) == last).all() and sorted(last) == sorted(ids)
    for got, counts in phrases(last, 4):
        k = got.shape[1]
        want = Counter(tuple(ids[i:i + k].tolist()) for i in range(len(ids) - k + 1) if (ids[i:i + k] > 0).all())
        assert {tuple(p): int(c) for p, c in zip(got.tolist(), counts)} == want


def test_words_and_breaks():
    got = cut_texts(pa.array(["A b\tc. D,e  f", "", "x| y"])).to_pylist()
    assert [w for w in got if w != "\n"] == ["a", "b", "c", "d", "e", "f", "x|", "y"]
    assert "".join("|" if w == "\n" else "." for w in got).replace("||", "|") == "...|.|..|..|"


def test_scores_pass_64_bits(spark):
    big = 4_000_000_000_000_000_000
    got = spark.createDataFrame([(big, big, big + 1), (30, 31, 97)], "a bigint, l bigint, r bigint").selectExpr(
        "a", "l", "CAST(r AS DECIMAL(20,0)) AS r").select(_score("a", "CAST(l AS DECIMAL(20,0))", "r").alias("s")).collect()
    assert [r["s"] for r in got] == [2000000 * big // (2 * big + 1), 2000000 * 30 // 128]


def test_odd_rows(spark, odd_documents, no_documents):
    docs = [(r["lang"], r["text"]) for r in odd_documents.collect()]
    assert found(odd_documents, least=2) == brute(docs, 2)
    assert found(no_documents) == [] == found(odd_documents.filter("text is null"))
