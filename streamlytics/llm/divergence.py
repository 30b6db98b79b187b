"""How far the sources of each language are apart in their words.

A task counts with Arrow kernels: texts are lowered and split, terms dictionary-encoded, and hash
groupings give one row for each (language, source, term) it has met; what it holds is merged and sent
on whenever it grows beyond ``HELD`` rows. Spark adds these partial counts up, and keeps the terms of
``LEAST_DOCS`` documents. The counts are then dealt into columnar shards, by a hash of the term: a
shard holds about ``SHARD_CELLS`` cells of the table of terms and sources of one language, compares
its sources there column by column, and sends on sums per pair of sources and its own leading terms.

All arithmetic is on whole numbers: shares are parts of ``SCALE``, found by long division.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlytics.llm.common import written
from streamlytics.operators.enrich import broadcast_if_few

LEAST_DOCS = 10
TOP = 10
SLICE_BYTES = 4 << 20
HELD = 400_000
SHARD_CELLS = 1 << 19

# Fixed values of the measure: shares are counted in billionths, and every count is raised by two.
SCALE, RAISE = 10**9, 2

_SPLITS = r"[\x00-\x60\x7B-\x7F]+"  # what is no term, once A-Z are lowered


def _count(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of some rows."""
    parts = pc.split_pattern_regex(pc.ascii_lower(batch["text"]), _SPLITS)
    row, term = pc.list_parent_indices(parts), parts.flatten()
    some = pc.not_equal(term, "")
    row, term = row.filter(some), term.filter(some).dictionary_encode()
    group = pa.table({"lang": batch["lang"], "source": batch["source"]})
    own = pa.table({"row": row, "term": term.indices})
    own = own.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    own = own.append_column("lang", group["lang"].take(own["row"]))
    own = own.append_column("source", group["source"].take(own["row"]))
    found = own.group_by(["lang", "source", "term"], use_threads=False)
    found = found.aggregate([("count_all", "sum"), ([], "count_all")])
    return pa.table(
        [found["lang"], found["source"], term.dictionary.take(found["term"].combine_chunks()),
         found["count_all_sum"], found["count_all"]],
        names=_COUNTED,
    )


_COUNTED = ["lang", "source", "term", "n", "docs"]


def _merge(tables: list[pa.Table]) -> pa.Table:
    grouped = pa.concat_tables(tables).group_by(_COUNTED[:3], use_threads=False)
    merged = grouped.aggregate([("n", "sum"), ("docs", "sum")])
    return merged.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(_COUNTED)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        before = sizes[at - 1] if at else 0
        end = max(int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")), at + 1)
        yield batch.slice(at, end - at)
        at = end


def partial_counts(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) per task: occurrences and documents; rows may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for some in _slices(batch):
                held.append(_count(some))
                size += held[-1].num_rows
                if size > HELD:
                    held = [_merge(held)]
                    size = held[0].num_rows
                    if size > HELD // 2:
                        yield from held[0].to_batches(max_chunksize=50_000)
                        held, size = [], 0
        if held:
            yield from _merge(held).to_batches(max_chunksize=50_000)

    return rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n) of the terms that ``least_docs`` documents of a language hold."""
    clean = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = partial_counts(docs.select(*clean))
    # A term of every document has one row per task here, and one per source below.
    counts = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    everywhere = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return counts.withColumn("docs", everywhere).where(F.col("docs") >= least_docs).drop("docs")


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + RAISE) / (total + RAISE * terms)), three digits at a time, so that no
    step leaves 64 bits below totals of 9 * 10**15."""
    whole = np.int64(total + RAISE * terms)
    share, left = np.divmod(counts + np.int64(RAISE), whole)
    for _ in range(3):
        digits, left = np.divmod(left * 1000, whole)
        share = share * 1000 + digits
    return share + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q)); shares stay below 10**9 + 2, so the square fits."""
    return (p - q) ** 2 // (p + q)


_FOUND = "lang string, source string, part string, item string, value bigint"


def _shard(groups: pa.Table, counts: pa.Table, top: int) -> pa.Table:
    """What one shard knows: value per pair of sources, and the leading terms of each source.

    ``groups`` holds every source of the language with its totals, ``counts`` the shard's counts.
    """
    lang, v, all_n = (groups[c][0].as_py() for c in ("lang", "v", "lang_n"))
    sources, totals = groups["source"].to_pylist(), groups["group_n"].to_pylist()
    at = {s: i for i, s in enumerate(sources)}
    coded = counts["term"].combine_chunks().dictionary_encode() if counts.num_rows else None
    terms = coded.dictionary if coded else pa.array([], pa.string())
    table = np.zeros((len(sources), len(terms)), dtype=np.int64)
    if coded:
        table[[at[s] for s in counts["source"].to_pylist()], coded.indices.to_numpy()] = counts["n"].to_numpy()
    p = np.stack([shares(table[i], totals[i], v) for i in range(len(sources))]) if v else table + 1
    q = shares(table.sum(axis=0), all_n, v) if v else p[0]
    out = [[], [], [], []]

    def add(source, part, items, values):
        for column, some in zip(out, ([source] * len(items), [part] * len(items), items, values), strict=True):
            column.extend(some)

    for i, source in enumerate(sources):
        sums = [int(apart(p[i], p[j]).sum()) for j in range(len(sources)) if j != i]
        add(source, "pair", [s for s in sources if s != source], sums)
        own = np.flatnonzero((table[i] > 0) & (p[i] > q))
        value = apart(p[i][own], q[own])
        if len(own) > top:
            # All that tie with the last one stay, so that names can decide.
            least = np.partition(value, len(value) - top)[len(value) - top]
            own, value = own[value >= least], value[value >= least]
        add(source, "term", terms.take(pa.array(own)).to_pylist(), value.tolist())
    arrays = [pa.array(c, pa.int64() if i == 3 else pa.string()) for i, c in enumerate(out)]
    return pa.table(
        [pa.array([lang] * len(out[0]), pa.string()), *arrays],
        names=["lang", "source", "part", "item", "value"],
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language
    (part ``pair``, all of them) and the ``top`` terms that set it off from the language (``term``).

    A term is a run of ASCII letters and characters beyond ASCII; only A-Z are lowered. Values are
    floor((p - q)**2 / (p + q)) in billionths, summed over all kept terms for a pair. Ranks go by value,
    then by the bytes of the item. Defined cases: a null text, language or source is an empty one; a
    source without terms is compared as well; a language without kept terms gives pairs of value 0; equal
    rows all count; an empty table gives no rows; other columns are ignored; a text is counted whole, in
    memory of about ten times the longest text.
    """
    counts = written(kept_counts(docs, least_docs), "divergence-counts")
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    groups = docs.select(*named).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count("n").alias("cells"))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("n").alias("v"), F.sum("n").alias("lang_n"))
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("group_n", "v", "lang_n")}
    of_group = groups.join(totals.drop("cells"), ["lang", "source"], "left").join(langs, "lang", "left")
    of_group = written(of_group.select("lang", "source", *zero.values()), "divergence-groups")
    # As many shards as keep terms * sources small, at least one for each language.
    cells = (F.count("source") * F.max("v") / SHARD_CELLS).cast("bigint") + 1
    spread = broadcast_if_few(written(of_group.groupBy("lang").agg(cells.alias("shards")), "divergence-shards"))
    of_shard = of_group.join(spread, "lang").select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard")
    )
    dealt = counts.join(spread, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), "shards"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _shard(left, right, top)

    # Every shard of a language meets its groups, so those without a counted term are there too.
    keys = ["lang", "shard"]
    found = (
        of_shard.drop("shards").groupBy(*keys).cogroup(dealt.drop("shards").groupBy(*keys)).applyInArrow(run, _FOUND)
    )
    merged = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").cast("bigint").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = merged.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
