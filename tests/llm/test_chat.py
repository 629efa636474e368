from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, strategies as st
from orderloom.llm import chat
from orderloom.llm.queries import op8_chat
from pyspark.sql import functions as F

TURNS = "conv_id bigint, turn bigint, role string, text string"
MARKS = st.lists(st.sampled_from(["<", "|", "\\", "<|", "|>", "<|end|>", "<|image 0|>", "<|turn|>", "<|body|>", "a", "\n", "é"]), max_size=6).map("".join)


@given(st.lists(MARKS, max_size=4), MARKS)
def test_escapes_are_reversible_and_safe(texts, role):
    flat = chat.Flatten()
    for t in texts:
        flat.visit({"kind": "text", "text": t})
        flat.visit({"kind": "image", "text": None, "ref": "r", "units": 1})
    piece = f"{chat.TURN}{chat.escape(role)}{chat.BODY}{''.join(flat.out)}{chat.END}"
    got_role, parts = chat.parse_turn(piece)
    assert got_role == role
    assert "".join(v if k == "text" else f"[{v}]" for k, v in parts) == "".join(f"{t}[{i}]" for i, t in enumerate(texts))
    joined = "".join(chat.escape(t) for t in texts)
    assert "<|" not in joined and chat.unescape(joined) == "".join(texts)


def brute(rows):
    out = {}
    for c, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {
        c: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), sum(len(x) for r, x in t if r == "assistant"), sha("".join(x for r, x in t if r == "assistant")))
        for c, t in out.items()
    }


def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "</s>[INST] ok [/INST]"
    got = {r["conv_id"]: tuple(r)[1:5] for r in op8_chat(spark, folder).collect()}
    assert got == brute([*rows, (-1, 0, "user", odd), (-1, 1, "assistant", odd)])


def test_odd_rows(spark):
    rows = [
        (1, 1, "assistant", "<|end|>\\"), (1, 0, "user", None), (1, None, None, "x"), (None, 0, "user", "é" * 9), (None, 1, "assistant", ""),
        (2, 5, "assistant", "\U0001f600" * 70_000), (2, 7, "assistant", "|"), (3, 0, "odd\n<|body|>", "t"),
    ]
    typed = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS formatted", "2 AS f").withColumn("parts", chat.text_parts(F.col("text")))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(typed)).collect()}
    assert got == brute(rows)


def test_one_long_conversation_and_repeats(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(30_000)] + [(2, 0, "user", "same")] * 2
    typed = spark.createDataFrame(rows, TURNS).withColumn("parts", chat.text_parts(F.col("text")))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(typed)).collect()}
    assert got == brute(rows)


def test_typed_parts(spark):
    rows = [(1, 0, "user", [("text", "see <|", None, None), ("image", None, "a.png", 3), ("audio", None, "b.wav", None), ("text", "| end", None, None), ("document", None, "c.pdf", 2)])]
    out = chat.format_turns(spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")).first()
    assert [tuple(a) for a in out["attachments"]] == [("image", "a.png", 768), ("audio", "b.wav", 25), ("document", "c.pdf", 2048)]
    assert out["tokens"] == 2841 and out["loss_start"] == out["loss_end"]
    assert chat.parse_turn(out["formatted"])[1] == [("text", "see <|"), ("image", "0"), ("audio", "1"), ("text", "| end"), ("document", "2")]
    with pytest.raises(ValueError):
        chat.Flatten().visit({"kind": "video", "text": None, "ref": "x", "units": 1})


def test_empty(spark):
    typed = spark.createDataFrame([], TURNS).withColumn("parts", chat.text_parts(F.col("text")))
    assert chat.read_back(chat.format_turns(typed)).count() == 0
