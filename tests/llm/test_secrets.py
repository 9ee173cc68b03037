"""Secret scans against Python's regular expressions; links by a direct reading of their rule."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from footings.llm import secrets
from footings.llm.secrets import redacted, scan_secrets, secret_digests

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
OPAQUE, ENDPOINT = re.compile(secrets.OPAQUE), re.compile(secrets.ENDPOINT)


def base(text):
    text = text or ""
    return ([("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
            + [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
            + [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= 24])


def linked(text):
    """Weak spans with their complements in reach, pair by pair."""
    text = text or ""
    strong, out = base(text), set()
    weak = [("opaque", *m.span()) for m in OPAQUE.finditer(text)] + [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    for kind, s, e in weak:
        near = {k for k, a, b in strong + weak if max(a - e, s - b, 0) <= secrets.REACH and not (a < e and s < b)}
        secret = bool(near & {"assign", "hex"})
        if kind == "opaque":
            fits = "access" in near or ("endpoint" in near and secret)
        else:
            fits = "access" in near and (secret or "opaque" in near)
        if fits and not any(a <= s and e <= b for _, a, b in strong):
            out.add((kind, s, e))
    return out


def made_texts():
    rng = random.Random(11)
    parts = ["token=abcdefgh", "secret: 'short", "passwd = x", "api_key=\"A1b2C3d4\"", "secret=token: abcdefgh", "AKIA" + "Q" * 16,
             "AKIA" + "7" * 12, "AKIAAKIA" + "B2" * 9, "deadbeef" * 4, "f" * 23, "wJalrXUtnFEMI7MDENGbPxRfiCYEXAMPLEKEY",
             "https://s3.example.com/x?y=1", "db.eu-1.amazonaws.com", "word ", "é🎉 ", "\n", "x" * 300, " " * 450, "==", "9f8e7d6c5b4a39281706f5e4"]
    return ["".join(rng.choice(parts) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]


def test_base_and_linked_spans(spark, documents):
    texts = made_texts() + [None, "", "password=" + "a" * 40_000, ("token=abcdef " * 3000)]
    rows = [(k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in secret_digests(docs).collect()}
    some = 0
    for k, text in rows:
        order = {"assign": 0, "access": 1, "hex": 2, "opaque": 3, "endpoint": 4}
        strong = sorted(base(text), key=lambda s: (s[1], order[s[0]], s[2]))
        every = sorted({*strong, *linked(text)}, key=lambda s: (s[1], order[s[0]], s[2]))
        some += len(every) > len(strong)
        assert [got[k][f"n_{kind}"] for kind in ("assign", "access", "hex")] == [
            sum(s[0] == kind for s in strong) for kind in ("assign", "access", "hex")]
        text_of = lambda spans: ",".join(f"{n}:{a}:{b}" for n, a, b in spans)
        assert got[k]["base_sha256"] == hashlib.sha256(text_of(strong).encode()).hexdigest()
        assert got[k]["spans"] == text_of(every), text
    assert some > 20


def spans_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r["spans"] for r in secret_digests(docs).collect()}


def test_unspaced_assignments(spark):
    access, secret = "AKIA" + "IOSFODNN7EXAMPLE", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    env = f"AWS_ACCESS_KEY_ID={access}\nAWS_SECRET_ACCESS_KEY={secret}\n"
    shell = f"export AWS_ACCESS_KEY_ID={access}; export AWS_SECRET_ACCESS_KEY={secret}"
    alone = f"AWS_SECRET_ACCESS_KEY={secret}"
    assert spans_of(spark, [env, shell, alone]) == {0: "access:18:38,opaque:61:101", 1: "access:25:45,opaque:76:116", 2: ""}
    docs = spark.createDataFrame([(0, env)], "doc_id bigint, text string")
    assert redacted(docs).first()["text"] == "AWS_ACCESS_KEY_ID=[SECRET]\nAWS_SECRET_ACCESS_KEY=[SECRET]\n"


def test_long_parts_beside_their_complement(spark):
    access, run = "AKIA" + "Q" * 16, "a1" * 10
    texts, want = [], []
    for n in (401, 1000, 5000):
        long = ("xY7z" * n)[:n]
        texts += [f"{long} {access}", f"{access} {long}", f"{long} {'-' * 398} {access}", f"{long} {'.' * 399} {access}",
                  f"token={long} {run} db.internal", f"https://h/{long} {access} {run}"]
        want += [f"opaque:0:{n},access:{n + 1}:{n + 21}", f"access:0:20,opaque:21:{n + 21}",
                 f"opaque:0:{n},access:{n + 400}:{n + 420}", f"access:{n + 401}:{n + 421}",
                 f"assign:0:{n + 6},opaque:{n + 7}:{n + 27}",
                 f"endpoint:0:{n + 10},opaque:6:{n + 10},access:{n + 11}:{n + 31},opaque:{n + 32}:{n + 52}"]
    got = spans_of(spark, texts)
    assert [got[k] for k in range(len(texts))] == want


def test_prose(documents):
    got = {r["doc_id"]: r["base_sha256"] for r in secret_digests(documents).collect()}
    for r in documents.collect():
        order = {"assign": 0, "access": 1, "hex": 2}
        spans = sorted(base(r["text"]), key=lambda s: (s[1], order[s[0]], s[2]))
        assert got[r["doc_id"]] == hashlib.sha256(",".join(f"{n}:{a}:{b}" for n, a, b in spans).encode()).hexdigest()


def test_redaction(spark):
    texts = made_texts() + [None, "", "nothing here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    got = {r["doc_id"]: r for r in redacted(docs).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        spans = sorted({(a, b) for _, a, b in base(text)} | {(a, b) for _, a, b in linked(text)})
        out, at = "", 0
        merged = []
        for a, b in spans:
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            out, at = out + text[at:a] + "[SECRET]", b
        want = text if text is None else out + text[at:]
        assert got[k]["text"] == want
        assert got[k]["n_chars"] == (None if text is None else len(want))


def test_odd_rows(odd_documents, no_documents):
    assert scan_secrets(odd_documents).count() == 11
    out = redacted(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == 11
    assert out.filter(F.col("text").contains("[SECRET]")).count() == 1
    assert scan_secrets(no_documents).count() == 0 and redacted(no_documents).count() == 0
