"""Fill-in-middle texts, cut through an indexable skip list over the units of each text.

A unit is a code point, or what a pattern matches (words, lines); what it does not match between
two matches is a unit too. Every express lane node carries two widths, the units and the code points
it spans, so a descent from the top lane that adds up widths reaches the code point at which any unit
begins. A node spans ``LANE`` nodes of the lane below. The lowest stored lane has one node for
``LANE`` units; the units below it are matched again from where that node begins, so a text costs a
few numbers for each ``LANE`` units and not one for each.

Which cuts and which form a document gets is hashed from its number, in DataFrame functions; the
inverse, ``restored``, is DataFrame functions only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANE = 16
#: Characters of output in one Arrow batch; a longer text is a batch of its own.
BATCH_CHARS = 4 << 20

# The marks before prefix, suffix and middle, and the share of each form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20


def unit_ends(text: str, unit: re.Pattern, at: int = 0) -> Iterator[int]:
    """Where the units of ``text`` end, from the unit that begins at ``at``."""
    for found in unit.finditer(text, at):
        if found.end() == found.start():
            continue
        if found.start() > at:
            yield found.start()
        at = found.end()
        yield at
    if at < len(text):
        yield len(text)


class SkipList:
    """The units of a text, found by rank; without ``unit`` every code point is one."""

    def __init__(self, text: str, unit: re.Pattern | None = None):
        self.text, self.unit = text, unit
        if unit is None:
            self.size = len(text)
            units = np.full(-(-self.size // LANE), LANE, dtype=np.int64)
            if self.size % LANE:
                units[-1] = self.size % LANE
            points = units
        else:
            ends, units = [0], []
            found = unit_ends(text, unit)
            while node := list(islice(found, LANE)):
                ends.append(node[-1])
                units.append(len(node))
            self.size = sum(units)
            units, points = np.array(units, dtype=np.int64), np.diff(np.array(ends, dtype=np.int64))
        self.lanes = [(units, points)]
        while len(units) > LANE:
            first = np.arange(0, len(units), LANE)
            units, points = np.add.reduceat(units, first), np.add.reduceat(points, first)
            self.lanes.append((units, points))

    def point(self, rank: int) -> int:
        """The code points before unit ``rank``; all of them for a rank of ``size``."""
        node = units = points = 0
        for unit_width, point_width in reversed(self.lanes):
            while node < len(unit_width) and units + int(unit_width[node]) <= rank:
                units += int(unit_width[node])
                points += int(point_width[node])
                node += 1
            node *= LANE
        if self.unit is None:
            return points + rank - units
        for points in islice(unit_ends(self.text, self.unit, points), rank - units):
            pass
        return points


def rearranged(form: str, prefix: str, middle: str, suffix: str) -> str:
    """The text a model is trained on."""
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    if form == "spm":
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return prefix + middle + suffix


def _cut(text: str, form: str, a: int, b: int, unit: re.Pattern | None):
    """(units, prefix code points, middle code points, output); no cuts for a plain text."""
    skips = SkipList(text, unit)
    if form == "plain":
        return skips.size, None, None, text
    first, last = sorted((a % (skips.size + 1), b % (skips.size + 1)))
    first, last = skips.point(first), skips.point(last)
    output = rearranged(form, text[:first], text[first:last], text[last:])
    return skips.size, first, last - first, output


def _draws(key: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, unit: str | None = None) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    ``n`` counts units, the cuts are counted in code points and null in plain form. ``unit`` is a
    pattern (``r"\\w+"``: words), None for code points. A text that is empty or holds a mark is plain.
    Defined cases: a null text is empty, a null doc_id draws as an empty string; each of several equal
    rows gives a row; equal numbers draw equally whatever their texts; an empty table gives no rows;
    other columns are ignored; a text of any length is cut whole, in memory of a few times the text.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce("text", F.lit(""))
    h1, h2, h3, h4 = _draws(key, seed)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    plain = (text == "") | marked | (h3 % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(h4 % 100 < SPM_BELOW, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), form.alias("form"), h1.alias("a"), h2.alias("b"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(unit) if unit else None
        for batch in batches:
            texts, forms = batch["text"], batch["form"].to_pylist()
            a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
            at, cut, size = 0, [], 0
            for i, form in enumerate(forms):
                cut.append(_cut(texts[i].as_py(), form, a[i], b[i], pattern))
                size += len(cut[-1][3])
                if size >= BATCH_CHARS or i == len(forms) - 1:
                    yield _batch(batch.slice(at, i + 1 - at), cut)
                    at, cut, size = i + 1, [], 0

    return rows.mapInArrow(run, schema)


def _batch(rows: pa.RecordBatch, cut: list[tuple]) -> pa.RecordBatch:
    n, first, middle, output = (list(column) for column in zip(*cut, strict=True))
    numbers = [pa.array(c, pa.int64()) for c in (n, first, middle)]
    return pa.RecordBatch.from_arrays(
        [rows["doc_id"], numbers[0], rows["form"], numbers[1], numbers[2], pa.array(output, pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made of; exact, as a marked form has each mark once."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
