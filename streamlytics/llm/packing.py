"""Token sequences of fixed length: all documents concatenated and cut.

Each document is tokenised once. A task writes its documents' ids with the number of tokens it
had before them, so a first pass knows the token total of every partition and a second pass only
adds those totals up, in a tree of blocks of partitions. That gives each document its place in one
endless row of tokens, without sorting or moving a text. The row is cut every ``LENGTH`` tokens; only
its last sequence is shorter.

A window that lies inside the rows of a task leaves it as a whole sequence. Of a window that another
task's rows share, each task gives a boundary record, and only those are shuffled.

Words are tokenised when a task first meets them and then looked up, where the tokenizer cuts at
ASCII blanks and drops them, which ``splits_at_blanks`` checks; else whole texts are encoded.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlytics.llm.common import written
from streamlytics.operators.enrich import broadcast_if_few

LENGTH = 2048
END = 1
#: Characters that are cut into words at a time, and words whose ids a task remembers.
SLICE_CHARS = 5 << 20
REMEMBERED = 250_000  # and as many from before
#: Partitions, or blocks of them, that one window adds up.
BLOCK = 1024

# Fixed value: a split of letters, digits and signs, with the English endings that may begin by '.
_CLASSES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: ASCII signs, without ' and those that special tokens begin and end with.
_SIGNS = r"[!-&(-/:;=?@\[-`{}~]"
#: Small Latin letters and digits.
_LETTER = "[a-z0-9ß-öø-ÿ]"
#: Small Latin letters: one character each, in no other form.
_simple = re.compile("[a-zß-öø-ÿ]+").fullmatch
_ID = np.dtype("<u4")
#: Stands between words that are encoded together; a token that no tokenizer has.
_CUT = "\ue000cut\ue000"


def splits_at_blanks(definition: str) -> bool:
    """Whether a text's ids are those of its blank-separated parts, one after the other.

    So it is where blanks are part of no token and no step looks over them: characters are
    normalised one by one (or composed, which never reaches over a blank).
    """
    spec = json.loads(definition)
    steps = (spec.get("normalizer") or {}).get("normalizers") or [spec.get("normalizer")]
    known = all(s is None or s["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase", "Replace") for s in steps)
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer")]
    first = cuts[0] or {}
    drops = first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer") or (
        first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed"
    )
    return known and drops


def _splits_at_signs(definition: str) -> bool:
    """Whether letters, digits and signs never share a token, and case says nothing."""
    spec = json.loads(definition)
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    lower = any(s["type"] == "Lowercase" for s in steps)
    own = (cuts[0].get("pattern") or {}).get("Regex") == _CLASSES
    signs = len(cuts) == 2 and cuts[1].get("type") == "ByteLevel" and not cuts[1].get("use_regex")
    return lower and own and signs and bool(spec["model"].get("end_of_word_suffix"))


def _light(definition: str):
    """The same merges without the steps that change nothing in a simple word, and per id whether it
    ends a word, which tells where the ids of one word end."""
    from tokenizers import Tokenizer

    spec = json.loads(definition)
    spec["normalizer"], spec["added_tokens"] = None, []
    bytes_as_signs = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytes_as_signs]}
    ends_word = np.zeros(max(spec["model"]["vocab"].values()) + 1, dtype=bool)
    for token, at in spec["model"]["vocab"].items():
        ends_word[at] = token.endswith(spec["model"]["end_of_word_suffix"])
    tok = Tokenizer.from_str(json.dumps(spec))
    tok.no_truncation(), tok.no_padding()
    return tok, ends_word


def _gather(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray, offsets: np.ndarray):
    """Rows of variable length: row ``codes[0]``, ``codes[1]``, ... of ``flat``, whose rows have
    ``sizes``, one after the other; and how many values there are for each stretch of ``offsets``."""
    begin, own = np.cumsum(sizes) - sizes, sizes[codes]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    values = flat[np.arange(total) + np.repeat(begin[codes] - (ends - own), own)]
    return values, np.diff(np.concatenate([[0], ends])[offsets])


def _numbers(known: dict[str, int], words: list[str]) -> np.ndarray:
    return np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int64, count=len(words))


class WordIds:
    """Ids of words, encoded when they are first met and remembered while they are met again.

    A word has a number; the ids of all numbered words stand one after the other in ``row``, and
    ``sizes`` says how many each has.
    """

    def __init__(self, definition: str):
        from tokenizers import AddedToken, Tokenizer

        # Spark deals out the cores; a worker's own threads would share its one.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.definition, self.plain = definition, None
        self.tok = Tokenizer.from_str(definition)
        self.tok.no_truncation(), self.tok.no_padding()
        self.tok.add_special_tokens([AddedToken(_CUT, normalized=False)])
        self.cut = self.tok.token_to_id(_CUT)
        self.by_blanks = splits_at_blanks(definition)
        self.by_signs = self.by_blanks and _splits_at_signs(definition)
        # With the signs that it begins with, which are so in any case.
        self.added = [
            (t["content"], re.match(r"[!-/:-@\[-`{-~]*", t["content"])[0])
            for t in json.loads(definition)["added_tokens"]
        ]
        if self.by_signs:
            self.light, self.ends_word = _light(definition)
        none = np.zeros(0, dtype=_ID), np.zeros(0, dtype=np.int64)
        self.known, self.row, self.sizes = {}, *none
        self.older, self.older_row, self.older_sizes = {}, *none

    def of(self, words: list[str]) -> np.ndarray:
        """The numbers of ``words``, which are all different."""
        if len(self.known) > REMEMBERED:
            self.older, self.older_row, self.older_sizes = self.known, self.row, self.sizes
            self.known, self.row, self.sizes = {}, self.row[:0], self.sizes[:0]
        found = _numbers(self.known, words)
        new = np.flatnonzero(found < 0)
        missing = [words[i] for i in new.tolist()]
        before = _numbers(self.older, missing)
        kept = np.flatnonzero(before >= 0)
        again = before[kept]
        row, _ = _gather(self.older_row, self.older_sizes, again, np.array([0, len(again)]))
        found[new[kept]] = np.arange(len(again)) + len(self.sizes)
        self._keep([missing[i] for i in kept.tolist()], row, self.older_sizes[again])
        unknown = np.flatnonzero(before < 0)
        missing = [missing[i] for i in unknown.tolist()]
        self.learn(missing)
        found[new[unknown]] = _numbers(self.known, missing)
        return found

    def learn(self, words: list[str]) -> None:
        """Calls for many words each: a call costs more than a word."""
        parts = []
        for at in range(0, len(words), 1024):
            some = words[at : at + 1024]
            simple = list(filter(_simple, some)) if self.by_signs else []
            if simple:
                packed = self._encode(self.light, " ".join(simple))
                parts.append((simple, packed, np.diff(np.flatnonzero(self.ends_word[packed]), prepend=-1)))
                some = [w for w in some if not _simple(w)]
            for word in (w for w in some if _CUT[0] in w):
                ids = np.frombuffer(self.ids(word), dtype=_ID)
                parts.append(([word], ids, np.array([len(ids)])))
            some = [w for w in some if _CUT[0] not in w]
            if some:
                packed = self._encode(self.tok, _CUT.join(some))
                cuts = np.flatnonzero(packed == self.cut)
                sizes = np.diff([-1, *cuts, len(packed)]) - 1
                parts.append((some, np.delete(packed, cuts), sizes))
        if parts:
            named, rows, sizes = zip(*parts, strict=True)
            self._keep([w for some in named for w in some], np.concatenate(rows), np.concatenate(sizes))

    @staticmethod
    def _encode(tok, text: str) -> np.ndarray:
        """The ids alone, without the places in the text."""
        return np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=_ID)

    def _keep(self, words: list[str], row: np.ndarray, sizes: np.ndarray) -> None:
        assert len(words) == len(sizes) and int(sizes.sum()) == len(row)
        self.known.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words)), strict=True))
        self.row, self.sizes = np.concatenate([self.row, row]), np.concatenate([self.sizes, sizes])

    def ids(self, text: str) -> bytes:
        """The ids of a text as it is."""
        if self.plain is None:
            from tokenizers import Tokenizer

            self.plain = Tokenizer.from_str(self.definition)
            self.plain.no_truncation(), self.plain.no_padding()
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype=_ID).tobytes()

    def _rows(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words``, one after the other, and how many each has."""
        found = self.of(words.to_numpy(zero_copy_only=False).tolist())
        return _gather(self.row, self.sizes, found, np.arange(len(found) + 1))

    def _split(self, texts: pa.Array, rows) -> tuple[np.ndarray, np.ndarray]:
        """As ``rows`` gives it, of blank-separated parts, for whole texts."""
        # Arrow's ASCII blanks are space and \t to \r.
        parts = pc.ascii_split_whitespace(texts)
        coded = parts.flatten().dictionary_encode()
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        return _gather(*rows(coded.dictionary), coded.indices.to_numpy(), offsets)

    def _signed(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words that differ by case or by a sign before or after them are encoded once."""
        if not self.by_signs:
            return self._rows(words)
        apart = pc.replace_substring_regex(pc.ascii_lower(words), f"({_LETTER})({_SIGNS})", r"\1 \2")
        apart = pc.replace_substring_regex(apart, f"({_SIGNS})({_LETTER})", r"\1 \2")
        for token, signs in self.added:  # it is what it is in its own case only
            if pc.any(pc.match_substring(words, signs)).as_py():
                apart = pc.if_else(pc.match_substring(words, token, ignore_case=True), words, apart)
        return self._split(apart, self._rows)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, packed."""
        if not self.by_blanks:
            return [self.ids(t.as_py()) for t in texts]
        row, counts = self._split(texts, self._signed)
        ends = np.cumsum(counts)
        return [row[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)]


_loaded: dict[str, WordIds] = {}


def word_ids(definition: str) -> WordIds:
    """One for all tasks of a Python worker."""
    if definition not in _loaded:
        _loaded.clear()
        _loaded[definition] = WordIds(definition)
    return _loaded[definition]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``SLICE_CHARS`` bytes of text; a longer text is a piece alone."""
    sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        before = sizes[at - 1] if at else 0
        end = max(int(np.searchsorted(sizes, before + SLICE_CHARS, side="right")), at + 1)
        yield batch.slice(at, end - at)
        at = end


def tokenised(docs: DataFrame, definition: str, end: int = END) -> DataFrame:
    """(doc_id, ids, n, part, before) as a table: packed ids with ``end`` after them, how many, the
    partition that read the document, and the tokens it read before."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, ids binary, n bigint, part int, before bigint"
    last = np.array([end], dtype=_ID).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, total = word_ids(definition), TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in _slices(batch):
                ids = [i + last for i in words.encode(some["text"])]
                n = np.array([len(i) // _ID.itemsize for i in ids], dtype=np.int64)
                after = total + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], pa.array(ids, pa.binary()), pa.array(n),
                     pa.array(np.full(len(ids), part, dtype=np.int32)), pa.array(after - n)],
                    names=["doc_id", "ids", "n", "part", "before"],
                )
                total = int(after[-1])
                # The pool keeps what the kernels used for a slice, beside the words remembered.
                pa.default_memory_pool().release_unused()

    return written(rows.mapInArrow(run, schema), "packing-ids")


def prefix_sums(totals: DataFrame, key: str, value: str, block: int = BLOCK) -> DataFrame:
    """(key, base): the sum of ``value`` over all smaller keys, which are whole numbers from 0.

    Blocks of ``block`` keys are added up first, so no window holds more rows than that.
    """
    highest = totals.agg(F.max(key)).first()[0]
    if highest is None or highest < block:
        before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(value).over(before), F.lit(0))
        return totals.select(key, before.alias("base"))
    group = f"{key}_block"
    blocks = totals.withColumn(group, F.expr(f"{key} div {block}"))
    sums = blocks.groupBy(group).agg(F.sum(value).alias(value))
    above = prefix_sums(sums, group, value, block).withColumnRenamed("base", "_above")
    inner = Window.partitionBy(group).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(inner), F.lit(0))
    return blocks.withColumn("_inside", inside).join(above, group).select(
        key, (F.col("_above") + F.col("_inside")).alias("base")
    )


def placed(tokens: DataFrame) -> DataFrame:
    """``tokens`` (see ``tokenised``) with ``place``: the tokens of all documents before it."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    bases = written(prefix_sums(totals, "part", "total"), "packing-bases")
    place = (F.col("base") + F.col("before")).alias("place")
    return tokens.join(broadcast_if_few(bases), "part").select("doc_id", "ids", "n", place)


def pieces(tokens: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of each piece of a document.

    ``tokens`` is a table made by ``tokenised``. Every id of every document lies in exactly one piece,
    and the pieces of a sequence fill it from 0 without gaps.
    """
    size = _ID.itemsize
    windows = F.sequence(F.expr(f"place div {length}"), F.expr(f"(place + n - 1) div {length}"))
    cut = placed(tokens).withColumn("sequence_id", F.explode(windows))
    begin = F.greatest(F.col("sequence_id") * length, F.col("place"))
    end = F.least((F.col("sequence_id") + 1) * length, F.col("place") + F.col("n"))
    start, took = begin - F.col("place"), end - begin
    # A document's ids stay where they are; a piece copies its own part of them only.
    ids = F.substring("ids", (start * size + 1).cast("int"), (took * size).cast("int"))
    return cut.select(
        "doc_id", start.alias("start"), took.alias("length"), ids.alias("ids"), F.col("n").alias("doc_tokens"),
        "sequence_id", (begin - F.col("sequence_id") * length).alias("offset"),
    )


_SEQUENCE = "sequence_id bigint, offset bigint, n bigint, ids binary, ends array<int>"


def sequences(tokens: DataFrame, length: int = LENGTH) -> DataFrame:
    """(sequence_id, n, ids, ends) of every sequence: its packed ids, how many, and the places in it
    after which a document ends. All have ``length`` ids but the last, which may have fewer.

    Rows that follow each other in a task fill whole windows there; what is left at both ends of such a
    run are boundary records, at most two a run, which meet by sequence_id.
    """
    rows = placed(tokens)
    size = _ID.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        ends: list[int] = []
        begin = at = None  # the place of the first held token, and the place after the last one
        out: list[tuple] = []

        def flush():
            nonlocal held, ends, begin
            if held:
                window = begin // length
                out.append((window, begin - window * length, at - begin, b"".join(held), ends))
            held, ends, begin = [], [], at

        def batch_out():
            nonlocal out
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
            names = ["sequence_id", "offset", "n", "ids", "ends"]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            out = []
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for place, n, ids in zip(*(batch[c].to_pylist() for c in ("place", "n", "ids")), strict=True):
                if place != at:
                    flush()
                    begin = at = place
                done = 0
                while done < n:
                    took = min(n - done, length - at % length)
                    held.append(ids[done * size : (done + took) * size])
                    done, at = done + took, at + took
                    if done == n:
                        ends.append((at - 1) % length + 1)
                    if at % length == 0:
                        flush()
                if len(out) >= 1000:
                    yield batch_out()
        flush()
        yield batch_out()

    found = rows.mapInArrow(run, _SEQUENCE)
    found = written(found, "packing-windows")
    whole = found.where(F.col("n") == length)
    parts = found.where(F.col("n") < length)
    # At most one record for each of a sequence's tokens meets here.
    met = parts.groupBy("sequence_id").agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("offset", "ids", "ends"))).alias("p")
    )
    joined = met.select(
        "sequence_id",
        "n",
        F.aggregate("p", F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"),
        F.flatten(F.transform("p", lambda p: p["ends"])).alias("ends"),
    )
    return whole.select("sequence_id", "n", "ids", "ends").unionByName(joined)


def packed(docs: DataFrame, definition: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces (see ``pieces``) of all documents in sequences of ``length`` tokens.

    ``definition`` is the JSON of a tokenizer; ``end`` follows each document. Sequences have no gap, so
    padding is at most one sequence's, at the very end. Documents follow each other as they are stored;
    ids and pieces are the same for any partitioning, their places are not. Defined cases: a null or
    empty text has the end id alone; a null doc_id stays null; each of several equal rows is packed; an
    empty table gives no rows; other columns are ignored; a long text is cut into as many pieces as it
    fills windows, in memory of about ten times the text.
    """
    return pieces(tokenised(docs, definition, end), length)
