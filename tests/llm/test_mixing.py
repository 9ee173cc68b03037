"""Weighted fair queueing against a sequential queue."""

import hashlib
import math
import random
import re

import pytest

from footings.llm import mixing
from footings.llm.hashing import sums_before
from footings.llm.mixing import mix, mixed_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, share=1.5, repeats=2):
    """copies per (id, text), targets per source; rows are (id, text, source)."""
    docs = []
    for k, t, s in rows:
        key = f"mix:{'' if k is None else k}:{t or ''}"
        docs.append((int(hashlib.md5(key.encode()).hexdigest()[:15], 16), k, len(WORD.findall(t or "")), s))
    sizes = {}
    for *_, n, s in docs:
        sizes[s] = sizes.get(s, 0) + n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in full]
        if not left:
            break
        level = (budget - sum(repeats * sizes[s] for s in full)) / sum(weight[s] for s in left)
        over = {s for s in left if repeats * sizes[s] <= level * weight[s]}
        if not over:
            break
        full |= over
    target = {s: float(repeats * sizes[s]) if s in full else level * weight[s] for s in names}
    turns = []
    for s in names:
        through = 0
        for o, k, n, _ in sorted((d for d in docs if d[3] == s), key=lambda d: (d[0], d[1] is not None, d[1] or 0)):
            through += n
            if n:
                turns += [(math.floor((through + p * sizes[s]) / target[s] * 2.0 ** 40), o, k, p, n) for p in range(repeats)]
    spent, copies = 0, {}
    for _, o, k, _, n in sorted(turns, key=lambda t: (t[0], t[1], t[2] is not None, t[2] or 0, t[3])):
        if spent + n > budget:
            break
        spent += n
        copies[o, k] = copies.get((o, k), 0) + 1
    return {(o, k): copies.get((o, k), 0) for o, k, *_ in docs}, target


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


@pytest.mark.parametrize("seed", range(3))
def test_against_a_queue(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "é", "", None, "Z"][:seed * 2 + 2]
    rows = [(k, "w " * rng.randint(0, 30), rng.choice(names + names[:1] * 5)) for k in range(400)]
    copies, target = brute(rows)
    got = mix(frame(spark, rows)).collect()
    assert {(r["_order"], r["doc_id"]): r["copies"] for r in got} == copies
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-12)
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    taken, most = {}, max(r["size"] for r in got)
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 2 * most for s in target)


def test_cut_inside_ties_of_many_equal_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SMALL", 4)
    rows = [(k, "one two", f"s{k:04d}") for k in range(300)]
    copies, _ = brute(rows)
    got = mix(frame(spark, rows)).collect()
    assert {(r["_order"], r["doc_id"]): r["copies"] for r in got} == copies


def test_mixed_rows(spark, odd_documents, no_documents):
    taken = mix(odd_documents).groupBy("doc_id").sum("copies").collect()
    out = mixed_documents(odd_documents)
    assert out.columns == odd_documents.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["sum(copies)"] for r in taken if r["sum(copies)"]}
    again = mix(odd_documents.repartition(5)).collect()
    assert sorted(map(repr, mix(odd_documents).collect())) == sorted(map(repr, again))
    assert mix(no_documents).count() == 0 and mixed_documents(no_documents).count() == 0


def test_sums_before_over_two_levels(spark):
    rng = random.Random(4)
    rows = [(g, c, rng.randint(1, 9)) for g in (1, 2) for c in rng.sample(range(1 << 15), 300)]
    got = sums_before(spark.createDataFrame(rows, "g int, c bigint, v bigint"), ["g"], "c", "v", 15).collect()
    assert len(got) == 600
    assert all(r["before"] == sum(v for g, c, v in rows if g == r["g"] and c < r["c"]) for r in got)
