import random
import zlib
from pathlib import Path

import nasty
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from streamlytics.llm import packing
from streamlytics.llm.packing import WordIds, pieces, prefix_sums, sequences, tokenised
from streamlytics.llm.packing_query import TOKENIZER
from streamlytics.llm.queries import all_queries

DEFINITION = Path(TOKENIZER).read_text()


PLAIN = Tokenizer.from_str(DEFINITION)


def plain(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 1]


def test_word_by_word_is_the_tokenizer():
    rng = random.Random(3)
    pool = ["don't", "it's ", " 's", "\t", "\n\n", "\v", "\f", "\r\n", "\x1c", "\x85", " ", " ", " ", "İ", "Σ", "ΑΣ", "é", "é", "́",
            " ́", "漢字", "😀", "12.5", "word,", "Word", "WORD.", "(word)", "a,b;C", "<|ENDOFTEXT|>", "größe", "straße", "éè", "ÿ", "À", "ö̂", "words", "x@y.z", "_a_", "5%", "[INST]", "`", "<|endoftext|>", "<|startoftext|> ", "a<|endoftext|>b", "...", "!?", "x" * 50, "\ue000cut\ue000", "\ue000cut", "\ue000", "ﬁ", "A", "\x00", "Å", "q̣̇", ""]
    texts = ["", " ", *("".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(900))]
    words, tok = WordIds(DEFINITION), Tokenizer.from_str(DEFINITION)
    assert words.by_blanks
    got = [np.frombuffer(i, dtype="<u4").tolist() for i in words.encode(pa.array(texts))]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    half = pa.array(texts).slice(100, 200)
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in words.encode(half)] == got[100:300]


def test_other_tokenizers_take_whole_texts():
    definition = Path("/opt/tokenizers/byte_bpe_50k.json").read_text()
    words, tok = WordIds(definition), Tokenizer.from_str(definition)
    texts = ["two  words\n", "", "é 漢"]
    assert not words.by_blanks
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in words.encode(pa.array(texts))] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_few_words_are_remembered(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    words, tok = WordIds(DEFINITION), Tokenizer.from_str(DEFINITION)
    for text in ("a b c d e f g a b", "g h a", "b c i j k"):
        assert np.frombuffer(words.encode(pa.array([text]))[0], dtype="<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(words.known) <= 5 + 9


def test_signs_are_cut_off_words_in_any_language():
    """Else each word is encoded anew with each sign beside it."""
    words, tok = WordIds(DEFINITION), Tokenizer.from_str(DEFINITION)
    text = "café café, (café) CAFé. café; größe größe!  ñ, 'ñ' =\u0338é é=\u0338"
    assert np.frombuffer(words.encode(pa.array([text]))[0], dtype="<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    assert {w for w in words.known if "caf" in w or "gr" in w} <= {"café", "größe"}


def check(docs, length, parts):
    """Pieces and sequences hold every id of every document once, in order, without gaps."""
    tokens = tokenised(docs.repartition(parts), DEFINITION)
    found = pieces(tokens, length).collect()
    by_sequence = {}
    for r in found:
        assert r.length == len(r.ids) // 4 and 0 < r.length <= length
        by_sequence.setdefault(r.sequence_id, []).append(r)
    filled = {}
    for s, own in by_sequence.items():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        filled[s] = sum(r.length for r in own)
    assert sorted(filled) == list(range(len(filled)))
    assert all(n == length for s, n in filled.items() if s < len(filled) - 1)
    row, texts = [], []
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.start == len(row)
        row += np.frombuffer(r.ids, dtype="<u4").tolist()
        if len(row) == r.doc_tokens:
            texts.append((r.doc_id, tuple(row)))
            row = []
    assert not row
    whole = {r.sequence_id: r for r in sequences(tokens, length).collect()}
    assert sorted(whole) == sorted(filled)
    for s, own in by_sequence.items():
        assert bytes(whole[s].ids) == b"".join(bytes(r.ids) for r in own) and whole[s].n == filled[s]
        assert list(whole[s].ends) == [r.offset + r.length for r in own if r.start + r.length == r.doc_tokens]
    return texts


@pytest.mark.parametrize("length,parts", [(7, 5), (16, 1), (2048, 3), (1, 2)])
def test_awkward_rows(spark, length, parts):
    docs = nasty.docs(spark)
    if length == 1:
        docs = docs.where("length(coalesce(text, '')) < 1000")
    texts = check(docs, length, parts)
    want = [(r[0], tuple(plain(r[1]))) for r in nasty.ROWS if length > 1 or len(r[1] or "") < 1000]
    assert sorted(texts, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    tokens = tokenised(nasty.empty(spark), DEFINITION)
    assert pieces(tokens).count() == 0 and sequences(tokens).count() == 0


def test_pieces_are_cut_without_python_workers(spark, capsys):
    """Workers and their batches beside a grown heap took an executor over its memory."""
    tokens = tokenised(nasty.docs(spark), DEFINITION)
    pieces(tokens).explain()
    plan = capsys.readouterr().out
    assert "Generate" in plan and not any(word in plan for word in ("Arrow", "Pandas", "Python"))


def test_prefix_sums_in_blocks(spark):
    rng = random.Random(1)
    rows = [(k, rng.randrange(1 << 40)) for k in range(0, 300, 2)]
    df = spark.createDataFrame(rows, "part int, total bigint")
    want = {k: sum(v for j, v in rows if j < k) for k, _ in rows}
    for block in (2, 16, 1024):
        assert dict(map(tuple, prefix_sums(df, "part", "total", block).collect())) == want


def test_query_on_the_given_table(spark):
    found = all_queries()["op11_concat_and_cut"](spark, SF)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = found.collect()
    texts = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    own = {}
    for r in rows:
        ids = texts[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(ids, dtype="<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(texts[r.doc_id])
        own.setdefault(r.doc_id, []).append((r.start, r.length))
    assert own.keys() == texts.keys()
    for d, cut in own.items():
        cut.sort()
        assert [s for s, _ in cut] == list(np.cumsum([0, *[n for _, n in cut]])[:-1]) and sum(n for _, n in cut) == len(texts[d])
    totals = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sorted(t.n for t in totals)[1:] == [2048] * (len(totals) - 1)
