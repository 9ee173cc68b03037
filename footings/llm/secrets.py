"""Secret scans: base patterns, and multipart credentials linked by interval joins.

Base kinds are found on their own.  Two weaker kinds mean little alone: an opaque run of
characters (it could be anything) and an endpoint.  They are reported only when they stand
near complementary parts: a bare opaque run needs an access identifier or an endpoint with
a secret in reach, an endpoint needs a secret.  Reach is a distance in code points inside
one document (the scope); parts meet by an interval join on (document, window of the text).

Spans are [start, end) in code points.  Spark functions only: a pattern's gaps (`split`)
and matches (`regexp_extract_all`) give the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footings.session import truncate_lineage

# The patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"          # AKIA and its whole run, 20 characters or more
HEX = r"[0-9a-f]{24,}"                 # whole runs of 24 characters or more
ASSIGN_VALUE = 6
# Weak kinds.
OPAQUE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"(?:[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]+|\b[a-z0-9][a-z0-9.-]*\.(?:amazonaws\.com|internal)\b)"
REACH = 400
SALTS = 32

KINDS = ("assign", "access", "hex")
SPANS = "array<struct<start:int,end:int>>"
LINKED = "array<struct<start:int,end:int,kind:string>>"


SECTION = 64


def _pieces(text: Column, pattern: str, keep=None) -> Column:
    """Per match of a pattern: the gap before it, its size, and whether `keep` keeps it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return F.transform(found, lambda m, i: F.struct(
        F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"),
        (keep(m) if keep else F.lit(True)).alias("keep")))


def _section(first: Column) -> Column:
    """Spans of SECTION pieces from `first` on, relative to the section, and its length."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,keep:boolean>>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        end = begin + p["size"]
        one = F.struct(begin.alias("start"), end.alias("end"), p["keep"].alias("keep"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.aggregate(F.slice("_pieces", first, SECTION), start, step)


def scan(text: Column, pattern: str, name: str, df: DataFrame, keep=None) -> DataFrame:
    """Add the spans of the leftmost non-overlapping matches of a pattern as column `name`.

    `keep` may drop matches by their text.  Positions are running sums over gaps and
    matches, taken in sections, so that no array grows with the square of the matches.
    """
    hit = F.regexp_instr(text, F.lit(pattern)) > 0
    df = df.withColumn("_pieces", F.when(hit, _pieces(text, pattern, keep)))
    firsts = F.sequence(F.lit(1), F.size("_pieces"), F.lit(SECTION))
    df = df.withColumn("_parts", F.when(F.col("_pieces").isNotNull(), F.transform(firsts, _section)))
    bases = F.aggregate(
        "_parts", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("bases")),
        lambda acc, p: F.struct((acc["at"] + p["at"]).alias("at"),
                                F.concat(acc["bases"], F.array(acc["at"])).alias("bases")), lambda acc: acc["bases"])
    df = df.withColumn("_bases", bases)
    laid = F.flatten(F.transform("_parts", lambda p, k: F.transform(
        F.filter(p["out"], lambda s: s["keep"]), lambda s: F.struct(
            (s["start"] + F.get("_bases", k)).alias("start"), (s["end"] + F.get("_bases", k)).alias("end")))))
    return (df.withColumn(name, F.coalesce(laid, F.array().cast(SPANS)))
            .drop("_pieces", "_parts", "_bases"))


def find_parts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the spans of every kind: assign, access, hex, opaque, endpoint."""
    body = F.col("_body")
    docs = docs.withColumn("_body", F.coalesce(F.col(text), F.lit("")))
    docs = scan(body, ASSIGN, "assign", docs,
                lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE)
    for name, pattern in (("access", ACCESS), ("hex", HEX), ("opaque", OPAQUE), ("endpoint", ENDPOINT)):
        docs = scan(body, pattern, name, docs)
    return docs.drop("_body")


def link_parts(found: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak spans of each scope `_scope` that complementary parts support: _scope, linked array<struct>.

    Parts are keyed by (scope, side, window), windows as wide as the reach: what lies before
    a weak part by its end, what lies after it by its start.  A weak part looks into the
    windows of its own start and end and their neighbours, and the distance is then checked,
    so that parts of any length meet.  Spans have a least length and do not overlap within a
    kind, so a window holds a bounded number of them and no scope, however long, makes a hot key.
    """
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    parts = found.filter((F.size("opaque") + F.size("endpoint")) > 0).dropDuplicates(["_scope"]).select(
        "_scope", F.explode(F.concat(*[named(kind) for kind in (*KINDS, "opaque", "endpoint")])).alias("p"))
    parts = parts.select("_scope", "p.*")

    def keyed(before: str, after: str, around: int) -> DataFrame:
        """The parts once per window about their edge `before` (side 0) and `after` (side 1)."""
        places = [F.struct(F.lit(side).alias("_side"), (F.floor(F.col(edge) / reach) + step).cast("int").alias("_window"))
                  for side, edge in enumerate((before, after)) for step in range(-around, around + 1)]
        return parts.withColumn("_place", F.explode(F.array(*places))).select("*", "_place.*").drop("_place")

    weak = keyed("start", "end", 1).filter(F.col("kind").isin("opaque", "endpoint"))
    other = keyed("end", "start", 0).select("_scope", "_side", "_window", F.col("kind").alias("o_kind"),
                                            F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    # A span that covers another is one part, not two: it lies on neither side.
    apart = F.when(F.col("_side") == 0, F.col("start") - F.col("o_end")).otherwise(F.col("o_start") - F.col("end"))
    met = weak.join(other, ["_scope", "_side", "_window"]).filter(apart.between(0, reach))
    secret = F.col("o_kind").isin("assign", "hex")
    support = met.groupBy("_scope", "kind", "start", "end").agg(
        F.max(F.col("o_kind") == "access").alias("access"), F.max(secret).alias("secret"),
        F.max(F.col("o_kind") == "endpoint").alias("endpoint"), F.max(F.col("o_kind") == "opaque").alias("opaque"))
    kept = support.filter(
        ((F.col("kind") == "opaque") & (F.col("access") | (F.col("endpoint") & F.col("secret"))))
        | ((F.col("kind") == "endpoint") & (F.col("access") & (F.col("secret") | F.col("opaque")))))
    return kept.groupBy("_scope").agg(F.collect_list(F.struct("start", "end", "kind")).alias("linked"))


def _attach(found: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    """`found` with the linked spans of its scope that no base span covers, as `linked`."""
    # Rows of one text may be a third of all: they are dealt over SALTS tasks.
    linked = linked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(SALTS)).cast("int"))
    joined = salted.join(linked, ["_scope", "_salt"], "left").withColumn("linked", F.coalesce("linked", F.array().cast(LINKED)))
    base = F.concat("assign", "access", "hex")
    fresh = F.filter("linked", lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    return joined.withColumn("linked", fresh).drop("_salt")


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: key, _scope, assign, access, hex (base spans), linked (added spans).

    * A scope is a text: equal texts are linked once, every row gets the result.
    * A null text is empty; a null key stays a row of its own; repeated rows are repeated.
    * A linked span inside a base span is not reported again; base spans always stay.
    * Extra columns are ignored; an empty table gives no rows.  Only spans are shuffled,
      never texts.
    """
    rows = docs.select(F.col(key), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_scope"), F.col(text).alias("_text"))
    found = truncate_lineage(find_parts(rows, "_text").drop("_text"))
    return _attach(found, link_parts(found, reach), key).select(key, "_scope", *KINDS, "linked")


def all_spans(scanned: DataFrame) -> tuple[Column, Column]:
    """Base spans and all spans as arrays of (start, order of kinds, end, kind), sorted."""
    def of(kind: str, order: int) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("o"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    base = F.concat(*[of(kind, i) for i, kind in enumerate(KINDS)])
    more = F.transform("linked", lambda s: F.struct(
        s["start"].alias("start"), F.when(s["kind"] == "opaque", 3).otherwise(4).alias("o"),
        s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(base), F.array_sort(F.concat(base, more))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans and all spans as text."""
    scanned = scan_secrets(docs)
    base, every = all_spans(scanned)
    return scanned.select(
        "doc_id", *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(every).alias("spans"))


def redacted(docs: DataFrame, marker: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """`docs` with every reported span replaced by `marker`; n_chars, where present, follows the text.

    Overlapping spans are merged first.  Texts without spans, null texts too, are left
    exactly as they are.  Rows keep their columns and number.  Only texts that hold weak
    parts meet the linked spans in a join; the others are rewritten where they are read.
    """
    scope = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_packed"), F.col("text").alias("_text"),
                         scope.alias("_scope"))
    found = find_parts(packed, "_text")
    weak = (F.size("opaque") + F.size("endpoint")) > 0
    linked = truncate_lineage(link_parts(truncate_lineage(
        found.filter(weak).select("_scope", *KINDS, "opaque", "endpoint")), reach))
    alone = found.filter(~weak).withColumn("linked", F.array().cast(LINKED))
    joined = _attach(found.filter(weak).withColumn("_row", F.xxhash64("_packed")), linked, "_row")
    wanted = ["_packed", "_text", *KINDS, "linked"]
    both = alone.select(*wanted).unionByName(joined.select(*wanted))
    _, every = all_spans(both)
    spans = F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]), F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        ).otherwise(F.concat(acc, F.array(s)))

    both = both.withColumn("_spans", spans)
    both = both.withColumn("_merged", F.when(F.size("_spans") > 0, F.aggregate("_spans", F.array().cast(SPANS), merge)))
    # The kept stretches lie between the spans.
    ends = F.concat(F.array(F.lit(0)), F.col("_merged.end"))
    stretches = F.transform(F.concat(F.col("_merged.start"), F.array(F.length("_text"))), lambda b, i: F.substring(
        F.col("_text"), F.get(ends, i) + 1, b - F.get(ends, i)))
    both = both.withColumn("_new", F.when(F.col("_merged").isNotNull(), F.array_join(stretches, marker)))
    columns = []
    for name in docs.columns:
        own = F.col("_packed")[name]
        if name == "text":
            own = F.coalesce("_new", "_text")
        elif name == "n_chars":
            own = F.when(F.col("_new").isNotNull(), F.length("_new").cast(docs.schema[name].dataType)).otherwise(own)
        columns.append(own.alias(name))
    return both.select(*columns)
