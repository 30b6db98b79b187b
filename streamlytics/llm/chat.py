"""Chat training text with a loss mask taken from token offsets.

A conversation is rendered whole, its turns marked by control strings that are single tokens, and
encoded once with offsets. Turn spans and token spans are both sorted, so a binary search gives
the tokens of each assistant turn; the mask is read back from those tokens' offsets.

Control strings inside a text are escaped by one invisible sign after their first character, one
more than is already there, which can be undone exactly.

Rows are sorted by conversation and turn inside a partition and streamed, so a task holds one
conversation's current piece and not its whole partition. A conversation over ``PIECE_CHARS`` is
encoded in pieces cut at turn marks, where no token can straddle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from streamlytics.llm.common import id_number, id_text

PIECE_CHARS = 1 << 20

# The marks of this template, and control strings of common ones.
OPEN, CLOSE, BEGIN = "<|turn|>", "<|end|>", "<|text|>"
CONTROL = [
    OPEN, CLOSE, BEGIN, "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|user|>", "<|assistant|>",
    "<|system|>", "<|eot_id|>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>",
]
SIGN = "\u2060"

_tails = "|".join(sorted((re.escape(c[1:]) for c in CONTROL), key=len, reverse=True))
_control = re.compile(f"([<\\[])({SIGN}*)(?={_tails})")
_escaped = re.compile(f"([<\\[])({SIGN}+)(?={_tails})")


def escape(text: str) -> str:
    return _control.sub(lambda m: m[1] + SIGN + m[2], text)


def unescape(text: str) -> str:
    return _escaped.sub(lambda m: m[1] + m[2][1:], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered text and, per turn, the span of its escaped text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{BEGIN}", escape(text)
        parts += [head, body, CLOSE]
        spans.append((at + len(head), at + len(head) + len(body)))
        at = spans[-1][1] + len(CLOSE)
    return "".join(parts), spans


_mark = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(BEGIN)}(.*?){re.escape(CLOSE)}", re.S)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _mark.finditer(rendered)]


def load_tokenizer(definition: str):
    """A tokenizer whose control marks are single tokens and whose offsets keep blanks."""
    from tokenizers import AddedToken, Tokenizer, processors

    tok = Tokenizer.from_str(definition)
    tok.post_processor = processors.ByteLevel(trim_offsets=False)
    tok.add_special_tokens([AddedToken(c, normalized=False) for c in (OPEN, CLOSE, BEGIN)])
    tok.no_truncation(), tok.no_padding()
    return tok


def loss_mask(
    offsets: np.ndarray, spans: list[tuple[int, int]], trained: list[bool]
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Per token whether it is trained on, and the characters those tokens cover, per span.

    Both token ends and spans are sorted, so each span's first and last token are searched for.
    """
    mask = np.zeros(len(offsets), dtype=bool)
    covered = []
    for (start, end), wanted in zip(spans, trained, strict=True):
        if not wanted:
            continue
        first = int(np.searchsorted(offsets[:, 1], start, side="right"))
        last = int(np.searchsorted(offsets[:, 0], end, side="left"))
        if start == end or first >= last:
            covered.append((start, start))
            continue
        mask[first:last] = True
        covered.append((int(offsets[first, 0]), int(offsets[last - 1, 1])))
    return mask, covered


@dataclass
class _Conversation:
    """What has been read back from the pieces of one conversation."""

    conv_id: object
    turns: list[tuple[str, str]] = field(default_factory=list)
    size: int = 0
    n_turns: int = 0
    formatted_chars: int = 0
    loss_chars: int = 0
    n_tokens: int = 0
    n_loss_tokens: int = 0
    all_hash: object = field(default_factory=hashlib.sha256)
    loss_hash: object = field(default_factory=hashlib.sha256)

    def flush(self, tok) -> tuple[str, np.ndarray, np.ndarray]:
        rendered, spans = render(self.turns)
        encoded = tok.encode(rendered, add_special_tokens=False)
        offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
        trained = [role == "assistant" for role, _ in self.turns]
        mask, covered = loss_mask(offsets, spans, trained)
        for role, text in parse(rendered):
            self.n_turns += 1
            self.all_hash.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for start, end in covered:
            text = unescape(rendered[start:end])
            self.loss_chars += len(text)
            self.loss_hash.update(text.encode("utf-8", "surrogatepass"))
        self.formatted_chars += len(rendered)
        self.n_tokens += len(mask)
        self.n_loss_tokens += int(mask.sum())
        self.turns, self.size = [], 0
        return rendered, np.array(encoded.ids, dtype=np.int64), mask


_SUMMARY = """conv_id string, n_turns bigint, turns_sha256 string, loss_chars bigint,
loss_sha256 string, formatted_chars bigint, n_tokens bigint, n_loss_tokens bigint"""
_PIECES = "conv_id string, piece int, text string, ids array<bigint>, loss array<boolean>"


def _conversations(batches: Iterator[pd.DataFrame], tok) -> Iterator[tuple[_Conversation, int, tuple | None]]:
    """Pieces of conversations in order; a piece of None ends its conversation."""
    now, piece = None, 0
    for pdf in batches:
        for conv_id, role, text in zip(pdf["conv_id"], pdf["role"], pdf["text"], strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now, piece, now.flush(tok)
                    yield now, piece, None
                now, piece = _Conversation(conv_id), 0
            elif now.size >= PIECE_CHARS:
                yield now, piece, now.flush(tok)
                piece += 1
            now.turns.append((role or "", text or ""))
            now.size += len(now.turns[-1][1])
    if now is not None:
        yield now, piece, now.flush(tok)
        yield now, piece, None


def _in_order(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(width, "conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select(id_text("conv_id"), "role", "text")


def format_chats(conversations: DataFrame, definition: str) -> DataFrame:
    """(conv_id, piece, text, ids, loss): the training text, its token ids and their loss mask.

    ``definition`` is the JSON of a byte-level tokenizer. Turns are ordered by turn, then role and
    text; repeated rows are repeated turns. A null text or role is empty; all rows with a null
    conv_id make one conversation; an empty turn is marked and trains nothing; an empty table gives
    no rows; other columns are ignored.
    """

    def run(batches):
        tok = load_tokenizer(definition)
        for conv, piece, out in _conversations(batches, tok):
            if out is not None:
                text, ids, loss = out
                yield pd.DataFrame(
                    {"conv_id": [conv.conv_id], "piece": [piece], "text": [text],
                     "ids": [ids], "loss": [loss]}
                )

    return id_number(_in_order(conversations).mapInPandas(run, _PIECES), "conv_id")


def chat_summary(conversations: DataFrame, definition: str) -> DataFrame:
    """Per conversation what ``format_chats`` makes of it, read back from text, tokens and mask."""
    columns = [c.split()[0] for c in _SUMMARY.split(",")]

    def frame(rows):
        return pd.DataFrame(rows, columns=columns)

    def run(batches):
        tok, rows = load_tokenizer(definition), []
        for c, _, out in _conversations(batches, tok):
            if out is None:
                rows.append(
                    (c.conv_id, c.n_turns, c.all_hash.hexdigest(), c.loss_chars,
                     c.loss_hash.hexdigest(), c.formatted_chars, c.n_tokens, c.n_loss_tokens)
                )
            if len(rows) >= 1000:
                yield frame(rows)
                rows = []
        if rows:
            yield frame(rows)

    return id_number(_in_order(conversations).mapInPandas(run, _SUMMARY), "conv_id")
