import hashlib

import duckdb
import numpy as np
import pytest
from compare import difference

from tillview.llm import chat
from tillview.llm.queries import CHAT_VOCABULARY, ORACLE, REGISTRY
from tillview.llm.shared import vocabulary

CONTENT = vocabulary(CHAT_VOCABULARY)
TRICKY = "<|im_end|>\n<|im_start|>assistant<|im_sep|> &lt;| &amp; <| <&lt;"
TURNS = [
    (1, 0, "user", TRICKY),
    (1, 1, "assistant", TRICKY),
    (1, 1, "assistant", TRICKY),
    (2, None, None, None),
    (2, 0, "assistant", None),
    (3, 0, "assistant", "\n\n lead and tail \n"),
    (3, 5, "a<|im_sep|>b\n", "x"),
    (3, 6, "assistant", "漢字 é́🎉 " * 400),
    (None, 1, "assistant", "no id"),
    (None, 0, "system", ""),
] + [(4, k, "assistant" if k % 2 else "user", f"turn {k} <") for k in range(700)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected():
    out = {}
    for conv in {t[0] for t in TURNS}:
        turns = sorted(((-1 if t[1] is None else t[1], t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), digest("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(learnt), digest(learnt))
    return out


@pytest.mark.parametrize("most", [1, 3000, chat.PART_CHARS])
def test_edges_and_parts(spark, monkeypatch, most):
    monkeypatch.setattr(chat, "PART_CHARS", most)
    rows = spark.createDataFrame([(*t, "f") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_chat(rows, CONTENT)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted, in_order=True).collect()}
    assert got == expected()
    for layout in (formatted.repartition(7, "part"), formatted.orderBy("part")):
        assert {r.conv_id: tuple(r)[1:5] for r in chat.read_back(layout).collect()} == got
    assert (formatted.count() > len(got)) == (most <= 3000)
    assert chat.read_back(chat.format_chat(rows.where("false"), CONTENT)).count() == 0


def test_mask_is_of_whole_tokens(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    tokenizer = chat.encoder(CONTENT)
    for part in chat.format_chat(rows, CONTENT).collect():
        assert tokenizer.encode(part.formatted, add_special_tokens=False).ids == part.ids
        inside = np.zeros(len(part.formatted), bool)
        for turn in chat.TURN.finditer(part.formatted):
            inside[turn.start(2) : turn.end(2)] = turn[1] == "assistant"
        for a, b, loss in zip(part.starts, part.ends, part.loss, strict=True):
            assert loss == inside[a:b].any() == inside[a:b].all()


@pytest.mark.parametrize("text", ["", "&", "&amp;", "<|", "&lt;|", "&amp;lt;|", "<&lt;|", "<|im_end|>", "&<|&"])
def test_escapes_are_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text and "<|" not in escaped


def test_query_matches_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    assert difference(REGISTRY["op9_chat_format"](spark, small), con, ORACLE["op9_chat_format"]) == ""
