from __future__ import annotations

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from recollect.llm import chat

TRICKY = st.lists(st.sampled_from(["<", "|", "\\", "<|", "|>", chat.START, chat.END, "\n", "a", "é😀"]), max_size=12)


@given(TRICKY, TRICKY)
def test_pieces_read_back(role, text):
    role, text = "".join(role), "".join(text)
    piece, begin, end, attachments, tokens = chat.format_turn(role, [{"kind": "text", "text": text}])
    got_role, body = chat.read_piece(piece)
    assert (got_role, chat.unescape(body), attachments, tokens) == (role, text, [], 0)
    assert piece.count("<|") == 2 and piece[begin:end] == (body if role == "assistant" else "")


def test_parts_become_ordered_placeholders():
    parts = [
        {"kind": "text", "text": "see <|image|> "},
        {"kind": "image", "ref": "a.png", "width": 57, "height": 28},
        {"kind": "audio", "ref": "b.wav", "seconds": 1.01},
        {"kind": None, "text": " and "},
        {"kind": "document", "ref": None, "pages": 3},
        {"kind": "image", "ref": "c.png"},
    ]
    piece, _, _, attachments, tokens = chat.format_turn("user", parts)
    assert chat.read_piece(piece) == ("user", "see <\\|image|> <|image|><|audio|> and <|document|><|image|>")
    assert [(a["kind"], a["ref"], a["tokens"]) for a in attachments] == [
        ("image", "a.png", 3), ("audio", "b.wav", 26), ("document", None, 768), ("image", "c.png", 1),
    ]
    assert tokens == 798
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"kind": "video"}])


SCHEMA = "conv_id long, turn long, role string, text string, piece string, loss_begin string"


def expected(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learned)]
    return len(turns), digests[0], len(learned), digests[1]


def test_conversations_read_back_in_order(spark):
    rows = [
        (1, 1, "assistant", "b <|im_end|>"), (1, 0, "user", "a"), (1, 2, "assistant", None), (1, None, "system", "s"),
        (2, 0, None, None), (3, 0, "assistant", "é😀" * 20000), (3, 0, "assistant", "é😀" * 20000),
        (None, 5, "user", "lost"), (None, 4, "assistant", ""),
    ]
    turns = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert len(got) == 4
    for conv_id, row in got.items():
        mine = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0))
        assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) == expected(
            [r[2:] for r in mine]
        )
    assert got[2]["formatted_chars"] == len(chat.START) + 1 + len(chat.END) + 1


def test_typed_parts_column_and_empty_table(spark):
    schema = f"conv_id long, turn int, role string, text string, parts array<{chat.PART}>"
    part = ("image", None, "x.png", 56, 56, None, None)
    rows = [(1, 0, "user", "unused", [part]), (1, 1, "assistant", "used", None)]
    got = chat.format_turns(spark.createDataFrame(rows, schema)).orderBy("turn").collect()
    assert got[0]["attachments"] == [("image", "x.png", 4)] and got[0]["expanded_tokens"] == 4
    assert "<|image|>" in got[0]["piece"] and "used" in got[1]["piece"]
    empty = spark.createDataFrame([], schema)
    assert chat.read_back(chat.format_turns(empty)).collect() == []


def test_long_conversation_spread_over_files(spark):
    turns = spark.range(3000).selectExpr(
        "id % 2 AS conv_id", "id AS turn", "if(id % 3 = 0, 'assistant', 'user') AS role", "concat('t', id) AS text"
    )
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns.repartition(9))).collect()}
    for conv in (0, 1):
        mine = [("assistant" if i % 3 == 0 else "user", f"t{i}") for i in range(conv, 3000, 2)]
        row = got[conv]
        assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) == expected(mine)
