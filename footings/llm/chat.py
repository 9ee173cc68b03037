"""Chat formatting as a relational job: Spark expressions only.

Template (fixed values of this package).  A block is one or more turns of one role:

    <|role|>ROLE<|says|>TEXT<|next|>TEXT<|done|>

Adjacent turns of one role share a block, with `<|next|>` between their texts, so the
turns can be told apart again.  Inside roles and texts a backslash is doubled and `<|`
becomes `<\\|`; no control string can therefore arise from a text, and reading is exact.
The loss mask is a list of [start, end) spans in code points, one per assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, SAYS, NEXT, DONE = "<|role|>", "<|says|>", "<|next|>", "<|done|>"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans array<struct<start, end>>.

    * Turns are sorted by (turn, role, text); nulls come first.  Null roles and texts are
      empty; rows without a conv_id form one conversation; repeated rows are repeated turns.
    * Adjacent turns of one role are merged by slicing the sorted array at the places where
      the role changes; every array expression is linear in the turns.
    * A conversation is one output value, so its turns meet in one row by definition; no
      row holds more than one conversation.
    * Extra columns are ignored; an empty table gives no rows.
    """
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    chats = chats.select("conv_id", F.transform("t", lambda x: escaped(x["role"])).alias("roles"),
                         F.transform("t", lambda x: escaped(x["text"])).alias("texts"))
    starts = F.filter(F.sequence(F.lit(1), F.size("roles")),
                      lambda i: (i == 1) | (F.get("roles", i - 1) != F.get("roles", i - 2)))
    chats = chats.withColumn("starts", starts)
    ends = F.transform("starts", lambda s, i: F.coalesce(F.get("starts", i + 1), F.size("roles") + 1))
    chats = chats.withColumn("ends", ends).withColumn("blocks", F.transform(
        F.arrays_zip("starts", "ends"), lambda b: F.struct(
            F.get("roles", b["starts"] - 1).alias("role"),
            F.slice("texts", b["starts"], b["ends"] - b["starts"]).alias("texts"))))
    pieces = F.transform("blocks", lambda b: F.concat(
        F.lit(ROLE), b["role"], F.lit(SAYS), F.array_join(b["texts"], NEXT), F.lit(DONE)))
    chats = chats.withColumn("pieces", pieces).withColumn("formatted", F.array_join("pieces", ""))
    # Where each turn's text begins: everything before it, summed once along the turns.
    opener = F.transform("roles", lambda r, i: F.when(
        (i == 0) | (r != F.get("roles", i - 1)),
        F.length(r) + len(ROLE) + len(SAYS) + F.when(i == 0, 0).otherwise(len(DONE))).otherwise(len(NEXT)))
    chats = chats.withColumn("gaps", opener)
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.get("gaps", i)
        end = start + F.length(F.get("texts", i))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.concat(acc["spans"], span).alias("spans"))

    def sections(first: Column, last: Column) -> Column:
        return F.aggregate(F.sequence(first, last), state, step)

    # Sections of turns keep the growing arrays short; their results are laid end to end.
    width = 64
    firsts = F.sequence(F.lit(0), F.size("roles") - 1, F.lit(width))
    chats = chats.withColumn("parts", F.transform(
        firsts, lambda f: sections(f, F.least(f + width - 1, F.size("roles") - 1))))
    totals = F.aggregate(
        "parts", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("bases")),
        lambda acc, p: F.struct((acc["at"] + p["at"]).alias("at"),
                                F.concat(acc["bases"], F.array(acc["at"])).alias("bases")), lambda acc: acc["bases"])
    chats = chats.withColumn("bases", totals)
    spans = F.flatten(F.transform("parts", lambda p, k: F.transform(p["spans"], lambda s: F.struct(
        (s["start"] + F.get("bases", k)).alias("start"), (s["end"] + F.get("bases", k)).alias("end")))))
    chats = chats.withColumn("spans", spans)
    mask = F.filter("spans", lambda s, i: F.get("roles", i) == TRAINED)
    return chats.select("conv_id", "formatted", mask.alias("loss_spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """The turns back from the output: conv_id, turns array<struct<role, text>>, loss_texts array<string>."""
    quoted = {mark: mark.replace("|", r"\|") for mark in (ROLE, SAYS, NEXT, DONE)}
    blocks = F.filter(F.split("formatted", quoted[DONE]), lambda b: F.length(b) > 0)
    parts = F.transform(blocks, lambda b: F.split(F.substring(b, len(ROLE) + 1, 1 << 30), quoted[SAYS], 2))
    turns = F.flatten(F.transform(parts, lambda p: F.transform(
        F.split(p[1], quoted[NEXT]), lambda t: F.struct(unescaped(p[0]).alias("role"), unescaped(t).alias("text")))))
    loss = F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_texts"))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests read back from the output of `format_chats`."""
    read = read_chats(formatted)
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


EXTRA_TEXT = "</s>[INST] ok [/INST]"

SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7::BIGINT, 0::BIGINT, 'user', '{EXTRA_TEXT}'), (-7, 1, 'assistant', '{EXTRA_TEXT}')),
numbered AS (
  SELECT *, row_number() OVER w AS k, coalesce(lag(role) OVER w <> role, true) AS opens
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))
            + CASE WHEN opens THEN 24 + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) ELSE 8 END AS chars
  FROM numbered)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
