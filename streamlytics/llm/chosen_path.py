"""Near duplicates by a chosen-path set similarity join over 5-word shingles.

Equal shingle sets are first folded into one *class*. Each of ``TREES`` independent trees
branches a class by the least shingle under two of its own hash orders (its chosen minwise
tokens), so a node holds classes that share a chosen token. A node with at most ``NODE_ROWS``
classes is compared exhaustively on 128-coordinate signatures; a larger one branches again, on
two further coordinates picked by the node. After ``DEPTH`` levels what is still too large is
compared exhaustively in pairs of blocks, so nothing is capped.

A pair of similarity J survives one branching with chance 1 - (1 - J p)^2, p being the chance
below it; at J = 0.75 that never falls under 0.888, so six trees miss a pair with a chance of
at most 2e-6. Signatures only propose: every link is confirmed on the full sets.

Confirmation ships each proposed set once, to the group of classes it is chained to, and walks
that group breadth-first, so a group of m copies yields m - 1 links and never m^2 pairs. A group
too heavy for one task is confirmed cell by cell, a cell being what one node proposed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import id_number, id_text, written
from streamlytics.llm.components import components
from streamlytics.llm.key_filter import marked, told
from streamlytics.llm.shingles import constants, mix, shingle_sets
from streamlytics.session import pin

TREES = 6
COORDINATES = 128
NODE_ROWS = 4096
DEPTH = 4
GROUP_SHINGLES = 4_000_000
#: Four standard deviations below 0.75 at 128 coordinates.
PROPOSE = 0.59

_U = np.uint64
_XOR, _TIMES = constants(COORDINATES, 11), constants(COORDINATES, 12) | _U(1)


def _same_text():
    same_id = F.col("w.doc_id").eqNullSafe(F.col("t.doc_id"))
    return (F.col("w.text_key") == F.col("t.text_key")) & same_id


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each coordinate's own order."""
    least = np.full(COORDINATES, np.iinfo(_U).max, dtype=_U)
    for at in range(0, len(shingles), 512):
        block = (shingles[at : at + 512, None] ^ _XOR) * _TIMES
        np.minimum(least, block.min(axis=0), out=least)
    return least


def class_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        classes, sizes, roots, signs = [], [], [], []
        for s in shingle_sets(pdf["text"]):
            sizes.append(len(s))
            if not len(s):
                classes.append(None), roots.append(None), signs.append(None)
                continue
            least = signature(s)
            classes.append(class_of(s))
            roots.append(least[: 2 * TREES].view(np.int64).tolist())
            signs.append((mix(least) >> _U(56)).astype(np.uint8).tobytes())
        yield pd.DataFrame(
            {
                "doc_id": pdf["doc_id"],
                "text_key": pdf["text_key"],
                "n": sizes,
                "cls": classes,
                "roots": roots,
                "sign": signs,
            }
        )


def described(docs: DataFrame) -> DataFrame:
    """Per document its set size, class, root tokens and signature; written once."""
    rows = docs.select(id_text(), "text", F.xxhash64("text").alias("text_key")).mapInPandas(
        _describe,
        "doc_id string, text_key bigint, n bigint, cls binary, roots array<bigint>, sign binary",
    )
    return written(id_number(rows), "chosen-path-rows")


def _small(counts: DataFrame) -> DataFrame:
    return counts.where(f"n_node <= {NODE_ROWS}")


def _children(members: DataFrame, level: int) -> DataFrame:
    """Two further coordinates per node, the same for all its members."""
    picks = [
        F.pmod(F.xxhash64("node", F.lit(level), F.lit(k)), F.lit(COORDINATES - 2 * TREES))
        + 2 * TREES
        for k in (0, 1)
    ]
    return members.withColumn("pick", F.explode(F.array(*picks))).select(
        F.xxhash64(
            "node", "pick", F.expr("substring(sign, cast(pick AS int) + 1, 1)")
        ).alias("node"),
        "cls",
        "sign",
    )


def _blocks(members: DataFrame) -> DataFrame:
    """Every pair of blocks of a node as a node of its own."""
    block = F.pmod(F.xxhash64("cls"), F.col("n_blocks"))
    return (
        members.withColumn("n_blocks", F.ceil(F.col("n_node") * 2 / NODE_ROWS))
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)))
        .select(
            F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias(
                "node"
            ),
            "cls",
            "sign",
        )
    )


def _counted(members: DataFrame) -> DataFrame:
    counts = members.groupBy("node").agg(F.count("*").alias("n_node")).where("n_node > 1")
    return pin(counts)


def _propose(pdf: pd.DataFrame) -> pd.DataFrame:
    """Chain the members of one node whose signatures agree enough."""
    names = pdf["cls"].to_numpy()
    order = np.argsort(names)
    names, node = names[order], pdf["node"].iloc[0]
    signs = np.frombuffer(b"".join(pdf["sign"].to_numpy()[order]), dtype=np.uint8)
    signs = signs.reshape(len(names), COORDINATES)
    need = int(np.ceil(PROPOSE * COORDINATES))
    left = np.arange(len(names))
    out: list[tuple[bytes, bytes]] = []
    while len(left) > 1:
        hub, queue, found = left[0], [left[0]], []
        left = left[1:]
        while queue and len(left):
            at = queue.pop()
            near = (signs[left] == signs[at]).sum(axis=1) >= need
            queue += left[near].tolist()
            found += left[near].tolist()
            left = left[~near]
        if found:
            out += [(names[i], names[hub]) for i in [hub, *found]]
    return pd.DataFrame(
        {"node": [node] * len(out), "cls": [a for a, _ in out], "hub": [b for _, b in out]}
    )


def proposals(classes: DataFrame) -> DataFrame:
    """(node, cls, hub): cells of classes that one node chains together."""
    roots = classes.select("cls", "sign", F.posexplode("roots").alias("pos", "value")).select(
        F.xxhash64("pos", "value").alias("node"), "cls", "sign"
    )
    parts, members = [], roots
    for level in range(DEPTH + 1):
        counts = _counted(members)
        parts.append(members.join(_small(counts), "node").drop("n_node"))
        large = counts.where(f"n_node > {NODE_ROWS}")
        if large.isEmpty():
            break
        inside = members.join(large, "node")
        if level == DEPTH:
            parts.append(_blocks(inside))
        else:
            members = written(_children(inside, level), "chosen-path-level").distinct()
    return written(
        reduce(DataFrame.unionAll, parts)
        .groupBy("node")
        .applyInPandas(_propose, "node bigint, cls binary, hub binary"),
        "chosen-path-cells",
    )


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The full set of each wanted class, once per task; a text of another class is passed over."""
    seen: set[tuple] = set()
    for pdf in batches:
        keep, sets = [], []
        for at, s in enumerate(shingle_sets(pdf["text"])):
            pair = (pdf["cell"].iat[at], bytes(pdf["cls"].iat[at]))
            if pair not in seen and class_of(s) == pair[1]:
                seen.add(pair)
                keep.append(at)
                sets.append(s.tobytes())
        if keep:
            yield pdf[["cell", "cls"]].iloc[keep].assign(shingles=sets)


def linked(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning links of the graph 100 * intersection >= 75 * union, by breadth-first walk."""
    sizes = np.array([len(s) for s in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32).ravel()
    ends = np.cumsum(sizes)
    mark = np.zeros(int(flat.max()) + 1, dtype=bool)
    left = np.arange(len(sets))
    values, starts = flat, ends - sizes
    links: list[tuple[int, int]] = []
    queue: list[int] = []
    while len(left) > 1 or (queue and len(left)):
        if not queue:
            queue.append(int(left[0]))
            values, starts, left = _without(values, starts, sizes, left, np.arange(len(left)) > 0)
        at = queue.pop()
        own = flat[ends[at] - sizes[at] : ends[at]]
        mark[own] = True
        shared = np.add.reduceat(mark[values], starts, dtype=np.int64)
        mark[own] = False
        near = 100 * shared >= 75 * (sizes[left] + sizes[at] - shared)
        if near.any():
            links += [(int(i), at) for i in left[near]]
            queue += left[near].tolist()
            values, starts, left = _without(values, starts, sizes, left, ~near)
    return links


def _without(values, starts, sizes, left, keep):
    """The unvisited sets, laid end to end, after some were visited."""
    values = values[np.repeat(keep, sizes[left])]
    left = left[keep]
    lengths = sizes[left]
    return values, np.cumsum(lengths) - lengths, left


def _confirm(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("cls")
    names = pdf["cls"].to_numpy()
    links = linked([np.frombuffer(b, dtype=_U) for b in pdf["shingles"]]) if len(pdf) > 1 else []
    return pd.DataFrame(
        {"u": [names[a] for a, _ in links], "v": [names[b] for _, b in links]}, dtype=object
    )


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirmed links (u, v) between classes, enough to connect every component."""
    cells = proposals(classes)
    edges = cells.select(F.col("cls").alias("u"), F.col("hub").alias("v")).where("u <> v")
    groups = pin(components(edges.distinct()))
    named = classes.select(F.col("cls").alias("node"), "n", "rep")
    members = groups.join(named, "node")
    weights = members.groupBy("root").agg(F.sum("n").alias("weight"), F.count("*").alias("size"))
    fits = F.expr(f"weight <= {GROUP_SHINGLES} AND size <= {NODE_ROWS}")
    weighed = pin(weights)
    whole = members.join(weighed.where(fits), "root").select(
        F.xxhash64("root").alias("cell"), F.col("node").alias("cls"), "rep"
    )
    wanted = whole
    heavy = weighed.where(~fits)
    if not heavy.isEmpty():
        # Too heavy for one task: its cells, which hold every pair that some node proposed.
        inside = members.join(heavy.select("root"), "root").select(
            F.col("node").alias("cls"), "n", "rep"
        )
        parts = cells.join(inside, "cls").withColumn("cell", F.xxhash64("node", "hub", F.lit(1)))
        loads = parts.groupBy("cell").agg(F.sum("n").alias("weight"))
        n_blocks = F.greatest(F.lit(1), F.ceil(F.col("weight") * 2 / GROUP_SHINGLES))
        cut = parts.join(loads, "cell").withColumn("n_blocks", n_blocks.cast("bigint"))
        block = F.pmod(F.xxhash64("cls"), F.col("n_blocks"))
        cut = cut.withColumn("block", block).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1))
        )
        key = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))
        wanted = whole.union(cut.select(key.alias("cell"), "cls", "rep"))
    wanted = written(wanted.select("cell", "cls", "rep.doc_id", "rep.text_key"), "chosen-path-wanted")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    texts = marked(texts, wanted, ["doc_id", "text_key"]).where("maybe")
    found = wanted.alias("w").join(texts.alias("t"), _same_text()).select("w.cell", "w.cls", "t.text")
    sets = found.mapInPandas(_sets, "cell bigint, cls binary, shingles binary")
    return sets.groupBy("cell").applyInPandas(_confirm, "u binary, v binary")


def judged(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n, root (null without words), component_id."""
    rows = described(docs)
    classes = written(
        rows.where("cls IS NOT NULL")
        .groupBy("cls")
        .agg(
            F.first("n").alias("n"),
            F.first("roots").alias("roots"),
            F.first("sign").alias("sign"),
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_key")).alias("rep"),
        ),
        "chosen-path-classes",
    )
    roots = components(links(docs, classes)).select(F.col("node").alias("cls"), "root")
    labelled = classes.select("cls", "least_id").join(roots, "cls", "left").select(
        "cls", "least_id", F.coalesce("root", "cls").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = labelled.join(least, "root").select("cls", "root", "component_id")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(by_class, "cls", "left").select(
        "doc_id", "text_key", "n", "root", component.alias("component_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents whose 5-word shingle sets have a Jaccard similarity of at least 0.75 are linked;
    ``component_id`` is the least doc_id reachable over links and ``kept`` marks that document.
    Words are split at ASCII blanks and only A-Z are lower-cased. Defined cases: a null or blank
    text has the empty set and is linked with nothing; equal sets are always linked; a row without
    doc_id takes part in links, but is kept only if no row of its component has a doc_id; rows
    that repeat a doc_id are judged one by one by their own texts. An empty table gives no rows;
    other columns are ignored.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return judged(docs).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept")
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row left of each component, all columns as they were.

    The row with the least doc_id stays (a null id last, then the least text hash), also where
    rows repeat a doc_id. Own columns may have any names. Documents without words are linked with nothing and all stay.
    """
    rows = judged(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    winners = rows.where("root IS NOT NULL").groupBy("root").agg(first.alias("w")).select("w.doc_id", "w.text_key")
    copies = rows.groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n_rows"), F.max(F.col("root").isNotNull()).alias("worded")
    )
    wins = F.col("w.text_key").isNotNull()
    verdicts = written(
        copies.alias("t")
        .join(winners.alias("w"), _same_text(), "left")
        .select(
            "t.doc_id",
            "t.text_key",
            (F.col("worded") & ~wins).alias("goes"),
            (wins & (F.col("n_rows") > 1)).alias("one_stays"),
        ),
        "chosen-path-verdicts",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    texts = docs.select(row, "doc_id", F.xxhash64("text").alias("text_key"))
    # Rows that go are told apart without a shuffle of texts.
    pair = ["doc_id", "text_key"]
    stay = told(texts, verdicts.where("goes"), verdicts.where("NOT goes"), pair).where("NOT has").drop("has")
    again = verdicts.where("one_stays")
    if not again.isEmpty():
        found = marked(stay, again, pair)
        some = found.where("maybe").drop("maybe").alias("t")
        stay = found.where("NOT maybe").drop("maybe").union(some.join(again.alias("w"), _same_text(), "left_anti"))
        repeated = some.join(again.alias("w"), _same_text(), "left_semi")
        stay = stay.union(repeated.dropDuplicates(pair))
    return stay.select("row.*")
