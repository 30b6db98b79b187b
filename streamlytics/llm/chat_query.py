"""Query and SQL of the chat formatting."""

import re
from pathlib import Path

from streamlytics.llm.chat import BEGIN, CLOSE, CONTROL, OPEN, chat_summary
from streamlytics.llm.common import query, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# A conversation that quotes another template's marks.
QUOTE = "</s>[INST] ok [/INST]"

_tails = "|".join(sorted((re.escape(c[1:]).replace("'", "''") for c in CONTROL), key=len, reverse=True))
_MARKS = len(OPEN + BEGIN + CLOSE)
# An escape adds one sign per control string; each starts with < or [, which nothing else in it does.
SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{QUOTE}'), (-7, 1, 'assistant', '{QUOTE}'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(length(role) + length(text) + {_MARKS}
        + len(regexp_extract_all(role || chr(10) || text, '[<\\[](?:{_tails})')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op4_offset_chat", SQL)
def op4(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = [(-7, turn, role, QUOTE) for turn, role in enumerate(("user", "assistant"))]
    added = spark.createDataFrame(quoting, rows.schema)
    summary = chat_summary(rows.unionByName(added), Path(TOKENIZER).read_text())
    return summary.drop("n_tokens", "n_loss_tokens")
