"""Chat formatting: an exact round trip, the loss mask, and odd rows."""

import hashlib

from pyspark.sql import functions as F

from footings.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROWS = [
    (1, 0, "user", "hi <|done|> \\ <|next|> \\| <"), (1, 1, "user", "again"), (1, 2, "assistant", "|>"),
    (1, 3, "assistant", "<\\|says|>"), (1, 4, "tool<|role|>", None), (1, 5, "assistant", "🎉 end<"),
    (2, 1, None, "no role"), (2, None, "system", ""), (2, 1, "assistant", "tie"), (2, 1, "assistant", "tie"),
    (None, None, None, None), (3, 0, "user", None), (4, 9, "assistant", "y" * 50_000),
]


def expected(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for *_, r, t in sorted(turns)] for conv, turns in chats.items()}


def test_round_trip_and_mask(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(1) for c in ("texts", "roles", "spans", "formatted")})
    want = expected(ROWS)
    formatted = chat.format_chats(turns)
    got = {r["conv_id"]: r for r in chat.read_chats(formatted).collect()}
    assert {k: [(t["role"], t["text"]) for t in r["turns"]] for k, r in got.items()} == want
    assert {k: r["loss_texts"] for k, r in got.items()} == {
        k: [t for role, t in turns if role == "assistant"] for k, turns in want.items()}
    digests = {r["conv_id"]: r for r in chat.chat_digests(formatted).collect()}
    for k, turns in want.items():
        text = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert digests[k]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert digests[k]["formatted_chars"] == len(got[k]["formatted"])
        assert digests[k]["n_turns"] == len(turns)


def test_adjacent_turns_share_a_block(spark):
    rows = {r["conv_id"]: r["formatted"] for r in chat.format_chats(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert rows[1].count(chat.ROLE) == 4 and rows[1].count(chat.NEXT) == 2


def test_long_conversation_and_empty_table(spark):
    rows = [(1, k, ("user", "assistant", "assistant")[k % 3], f"t{k}") for k in range(1000)]
    formatted = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    read = chat.read_chats(formatted).first()
    assert [t["text"] for t in read["turns"]] == [f"t{k}" for k in range(1000)]
    assert read["loss_texts"] == [f"t{k}" for k in range(1000) if k % 3]
    assert chat.chat_digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.chat_digests(chat.format_chats(spark.createDataFrame(ROWS, SCHEMA)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
