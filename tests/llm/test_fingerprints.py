"""Locally consistent parsing: shared substrings share names; edits and successors."""

import random

import numpy as np

from footings.llm import fingerprints as fp


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def names_of(text):
    return {int(x) for _, names, width in fp.parse([text]) for x in names[width >= fp.WIDTH]}


def test_equal_substrings_share_interior_names_at_any_offset():
    rng = random.Random(1)
    middle = prose(rng, 300)
    a, b = names_of(prose(rng, 40) + middle + prose(rng, 11)), names_of(prose(rng, 7) + "x" + middle)
    inside = names_of(middle)
    assert len(a & b & inside) > 0.8 * len(inside)


def test_neighbouring_labels_differ_and_phrases_are_short():
    rng = np.random.default_rng(0)
    names = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    labels = fp._labels(names, np.array([0]))
    assert labels.max() <= 5 and (labels[1:] != labels[:-1]).all()
    begins = np.flatnonzero(fp._phrases(names, np.zeros(len(names), int)))
    assert np.diff(begins).min() >= 2 and np.diff(begins).max() <= 12


def test_likeness_follows_the_share_in_common():
    rng = random.Random(2)
    a, b = prose(rng, 3000), prose(rng, 3000)
    mixed = a[:len(a) * 2 // 3] + b[:len(a) // 3]
    x, y, z = fp.fingerprints([a, mixed, b])
    assert 0.5 < fp.likeness(x, y) < 0.85 and fp.likeness(x, z) < 0.05 and fp.likeness(x, x) == 1.0
    assert fp.likeness(x, x[:0]) == 0.0 and fp.likeness(x[:0], x[:0]) == 1.0
    assert (fp.as_names(fp.as_text(x)) == x).all()


def test_texts_do_not_depend_on_company():
    rng = random.Random(3)
    texts = ["", "a", "aa", "ab" * 700, "é" * 30, "🎉x", *[prose(rng, rng.randint(0, 200)) for _ in range(40)]]
    together = fp.fingerprints(texts)
    assert all((fp.fingerprints([t])[0] == f).all() for t, f in zip(texts, together))


def test_documents_against_brute_force(spark, documents):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in documents.collect()), reverse=True)
    got = {r["doc_id"]: r for r in fp.compare_with_edits(documents).collect()}
    assert len(got) == len(rows)
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        changed = fp.edited(text, following)
        a, b, c = fp.fingerprints([text, changed, following])
        r = got[doc]
        assert (r["n_chars"], r["edited_text"], r["fingerprint"], r["edited_fingerprint"]) == (
            len(text), changed, fp.as_text(a), fp.as_text(b))
        assert (r["near_edited"], r["near_next"]) == (fp.likeness(a, b), fp.likeness(a, c))


def test_several_buckets_and_odd_rows(spark, documents, odd_documents, no_documents, monkeypatch):
    one = {r["doc_id"]: r["edited_text"] for r in fp.compare_with_edits(documents).collect()}
    monkeypatch.setattr(fp, "BUCKET_DOCS", 7)
    assert {r["doc_id"]: r["edited_text"] for r in fp.compare_with_edits(documents).collect()} == one
    monkeypatch.setattr(fp, "BUCKET_DOCS", 2)
    rows = fp.fingerprint_digests(odd_documents).collect()
    assert len(rows) == 11
    same = {r["fingerprint"] for r in rows if r["doc_id"] == 1}
    assert len(same) == 1
    single = fp.compare_with_edits(odd_documents.filter("doc_id = 5")).first()
    assert single["near_next"] == 1.0
    assert fp.compare_with_edits(no_documents).count() == 0
    assert fp.fingerprint_documents(odd_documents).count() == 11
