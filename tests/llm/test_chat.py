import hashlib
import random
from pathlib import Path

import numpy as np
import pytest

from streamlytics.llm import chat
from streamlytics.llm.chat import CONTROL, SIGN, chat_summary, escape, format_chats, parse, render, unescape

DEFINITION = Path("/opt/tokenizers/byte_bpe_50k.json").read_text()
SCHEMA = "conv_id bigint, turn bigint, role string, text string, piece int"
ROWS = [
    (1, 1, "assistant", "zwei  \n", 0),
    (1, 0, "user", "</s>[INST] ok <|turn|>x<|end|>", 0),
    (1, 2, "assistant", None, 0),
    (1, 3, "assistant", "漢字 😀 é" + "x" * 3000, 0),
    (2, 0, None, "no role", None),
    (2, 0, "assistant", "tie", None),
    (2, 0, "assistant", "tie", None),
    (None, 5, "user", "", None),
    (3, None, "assistant", f"<{SIGN}s> [{SIGN}{SIGN}/INST] <s> <<SYS>>", None),
]


def test_escaping_can_be_undone():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice([*CONTROL, SIGN, "<", "[", "s>", "|", "a", " "]) for _ in range(8))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in CONTROL)
        assert parse(render([("user", text), ("assistant", text)])[0]) == [("user", text), ("assistant", text)]


def want(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv_id), key=lambda r: tuple((x is not None, x) for x in r[1:4]))
        turns = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for role, t in turns if role == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv_id] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss),
                        len(render(turns)[0]))
    return out


@pytest.mark.parametrize("piece", [1, 1 << 20])
def test_summary_reads_back_every_turn(spark, monkeypatch, piece):
    monkeypatch.setattr(chat, "PIECE_CHARS", piece)
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = {r[0]: tuple(r[1:6]) for r in chat_summary(df, DEFINITION).collect()}
    assert found == want(ROWS)


def test_mask_covers_assistant_tokens_only(spark):
    df = spark.createDataFrame(ROWS[:4], SCHEMA)
    row = format_chats(df, DEFINITION).collect()[0]
    tok = chat.load_tokenizer(DEFINITION)
    trained = [i for i, on in zip(row.ids, row.loss, strict=True) if on]
    assert tok.decode(trained, skip_special_tokens=False) == "".join(r[3] for r in (ROWS[0], ROWS[3]))
    assert np.array_equal(tok.encode(row.text, add_special_tokens=False).ids, row.ids)


def test_empty_table(spark):
    assert chat_summary(spark.createDataFrame([], SCHEMA), DEFINITION).count() == 0
