"""Mix sources to target weights by pivotal dependent rounding.

Every document should be taken ``target / source size`` times, which is rarely whole. The whole
part is certain; the rest is a fraction of the document, held in words. Two fractional documents
of one source meet, and a random one of two moves carries words from one to the other until one
of them is wholly taken or wholly left. The move's chance keeps every expected value, and the
words of the pair stay the same, so only a last residual of one document is rounded. Documents
are rounded in classes, those that are a large part of their source's target first; what a class
misses is added to the fractions of the next, so a source ends within half of one of its smallest
class's documents of its target.

Pairs meet in a reduction tree: blocks of about ``FAN_IN`` documents of a source leave one
residual each, and the residuals are blocks of the next level. No task sees more than a block,
however large a source is. Chances come from hashes of the documents, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import WORD, written
from streamlytics.llm.key_filter import marked, told
from streamlytics.operators.enrich import broadcast_if_few
from streamlytics.operators.ordered import running_count

#: Most elements of one array that repeats a row.
RUN = 1 << 16

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
FAN_IN = 256
#: Class borders, as parts of the source's target.
CLASSES = (1 / 4, 1 / 16, 1 / 64)

_UNIT = "struct<size:bigint, key:bigint, doc_id:bigint, text_key:bigint, n_rows:bigint, words:double>"


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """(source, source_size, target): all words shared by weight, capped at ``most`` times a source.

    Weights repeat over the sources in code point order, null last. A source whose share is above
    its cap gets the cap, and the rest is shared anew by weight until no share is above a cap.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumns({"all": F.lit(1), "last": F.col("source").isNull()})
    ranked = written(
        running_count(ranked, ["all"], ["last", "source"]).select(
            "source",
            "source_size",
            F.element_at(F.array(*map(F.lit, weights)), ((F.col("rn") - 1) % len(weights) + 1).cast("int"))
            .alias("weight"),
        ),
        "mixing-sources",
    )
    words = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, before = 0.0, -1
    capped = F.lit(False)
    while True:
        n, full, weight = ranked.agg(
            F.coalesce(F.sum(capped.cast("int")), F.lit(0)),
            F.coalesce(F.sum(F.when(capped, F.col("source_size") * most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
        ).first()
        if n == before or not weight:
            break
        before, level = n, (words - full) / weight
        capped = F.col("source_size") * most < F.col("weight") * F.lit(level)
    share = F.least(F.col("weight") * F.lit(level), (F.col("source_size") * most).cast("double"))
    return ranked.select("source", "source_size", share.alias("target"))


def _chance(a: Column, b: Column, level: int) -> Column:
    """A uniform number in [0, 1) that depends on the pair and the level only."""
    drawn = F.xxhash64(a["key"], a["doc_id"], b["key"], b["doc_id"], F.lit(level))
    return F.pmod(drawn, F.lit(1 << 53)).cast("double") / float(1 << 53)


def _with_words(unit: Column, words: Column) -> Column:
    return unit.withField("words", words)


def _meet(acc: Column, new: Column, level: int) -> Column:
    """One step of the fold: the held document meets the next; one of them leaves, decided."""
    held = acc["held"]
    up = F.least(held["size"] - held["words"], new["words"])
    down = F.least(held["words"], new["size"] - new["words"])
    gains = _chance(held, new, level) * (up + down) < down
    held_done = F.when(gains, up == held["size"] - held["words"]).otherwise(down == held["words"])
    held_words = F.when(gains, held["words"] + up).otherwise(held["words"] - down)
    new_words = F.when(gains, new["words"] - up).otherwise(new["words"] + down)
    settled = F.when(
        held_done, _with_words(held, F.when(gains, held["size"].cast("double")).otherwise(0.0))
    ).otherwise(_with_words(new, F.when(gains, F.lit(0.0)).otherwise(new["size"].cast("double"))))
    stays = F.when(held_done, _with_words(new, new_words)).otherwise(
        _with_words(held, held_words)
    )
    return F.when(
        held.isNull(), F.struct(new.alias("held"), acc["done"].alias("done"))
    ).otherwise(
        F.struct(stays.alias("held"), F.concat(acc["done"], F.array(settled)).alias("done"))
    )


def _reduced(units: DataFrame, level: int, name: str) -> DataFrame:
    """Each block's decided documents, and the one still held."""
    start = F.struct(
        F.lit(None).cast(_UNIT).alias("held"), F.array().cast(f"array<{_UNIT}>").alias("done")
    )
    folded = F.aggregate(
        F.array_sort(F.collect_list("unit")), start, lambda acc, x: _meet(acc, x, level)
    )
    blocks = units.groupBy("source", "block").agg(folded.alias("f"))
    return written(blocks.select("source", "block", "f.held", "f.done"), f"{name}-{level}")


def _tree(open_units: DataFrame, largest: int, name: str) -> DataFrame:
    """(source, unit) with every unit decided: its words are all of it or none."""
    decided, level, blocks = [], 0, -(-largest // FAN_IN)
    while True:
        reduced = _reduced(open_units, level, name)
        decided.append(reduced.select("source", F.explode("done").alias("unit")))
        if blocks <= 1:
            break
        open_units = reduced.select(
            "source", F.floor(F.col("block") / FAN_IN).alias("block"), F.col("held").alias("unit")
        )
        blocks, level = -(-blocks // FAN_IN), level + 1
    # The last residual of a source goes to the nearer whole number.
    decided.append(reduced.select("source", F.col("held").alias("unit")))
    taken = (F.col("unit.words") * 2 >= F.col("unit.size")).cast("bigint")
    return reduce(DataFrame.unionAll, decided).select("source", "unit", taken.alias("extra"))


def _rounded(split: DataFrame) -> DataFrame:
    """(source, doc_id, text_key, extra): 1 for the fractional documents that are taken."""
    due = F.sum(F.col("mass") * F.col("part")).alias("due")
    stats = written(
        split.groupBy("source", "rank").agg(
            F.count("*").alias("n_units"), F.sum("mass").alias("total"), due
        ),
        "mixing-classes",
    )
    ranks = sorted(stats.groupBy("rank").agg(F.max("n_units")).collect())  # one row per class
    carry = stats.select("source", F.lit(0.0).alias("carry")).distinct()
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    parts = [split.limit(0).select("source", "doc_id", "text_key", F.lit(0).cast("bigint").alias("extra"))]
    for rank, largest in ranks:
        here = stats.where(F.col("rank") == rank).alias("a").join(carry.alias("b"), same)
        here = here.select("a.*", (F.col("carry") / F.col("total")).alias("shift"))
        moved = F.least(F.greatest(F.col("part") + F.col("shift"), F.lit(0.0)), F.lit(1.0))
        unit = F.struct(
            F.col("mass").alias("size"),
            F.xxhash64("doc_id", "text_key").alias("key"),
            "doc_id",
            "text_key",
            "n_rows",
            (F.col("mass") * moved).alias("words"),
        )
        n_blocks = F.ceil(F.col("n_units") / FAN_IN)
        open_units = (
            split.where(F.col("rank") == rank)
            .alias("a")
            .join(here.select("source", "shift", "n_units").alias("b"), same)
            .select(
                "a.source",
                F.pmod(F.xxhash64("doc_id", "text_key", F.lit("block")), n_blocks).alias("block"),
                unit.cast(_UNIT).alias("unit"),
            )
        )
        done = _tree(open_units, largest, f"mixing-{rank}")
        parts.append(done.select("source", "unit.doc_id", "unit.text_key", "extra"))
        given = done.groupBy("source").agg(F.sum(F.col("extra") * F.col("unit.size")).alias("given"))
        left = here.alias("a").join(given.alias("b"), same).select(
            "a.source", (F.col("due") - F.col("given")).alias("missed")
        )
        carry = written(
            carry.alias("a")
            .join(left.alias("b"), same, "left")
            .select("a.source", (F.col("carry") + F.coalesce("missed", F.lit(0.0))).alias("carry")),
            "mixing-carry",
        )
    return reduce(DataFrame.unionAll, parts)


def _plan(docs: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per unit of ``n_rows`` equal rows: each is taken ``whole`` times, ``more`` of them once more."""
    rows = docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    units = written(
        rows.groupBy("source", "doc_id", "text_key", "size").agg(F.count("*").alias("n_rows")),
        "mixing-units",
    )
    targets = source_targets(
        units.select("source", (F.col("size") * F.col("n_rows")).alias("size")), weights, most
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A rate a hair under a whole number is that number.
    whole = F.least(F.floor(rate + 1e-9), F.lit(most))
    # Of n equal rows, the whole part of n * part is certain; one row carries the rest.
    due = F.greatest(rate - whole, F.lit(0.0)) * F.col("n_rows")
    certain = F.least(F.floor(due + 1e-9), F.col("n_rows"))
    rank = reduce(
        lambda found, k: F.when(F.col("size") > F.col("target") * CLASSES[k], k).otherwise(found),
        reversed(range(len(CLASSES))),
        F.lit(len(CLASSES)),
    )
    same = F.col("u.source").eqNullSafe(F.col("s.source"))
    split = units.alias("u").join(targets.alias("s"), same).select(
        "u.*", "source_size", "target", whole.alias("whole"), F.col("size").alias("mass"), rank.alias("rank"),
        certain.cast("bigint").alias("certain"), F.greatest(due - certain, F.lit(0.0)).alias("part"),
    )
    extra = _rounded(split.where((F.col("part") > 1e-9) & (F.col("mass") > 0)))
    same = (
        F.col("a.source").eqNullSafe(F.col("b.source"))
        & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        & (F.col("a.text_key") == F.col("b.text_key"))
    )
    return split.alias("a").join(extra.alias("b"), same, "left").select(
        "a.doc_id", "a.text_key", "a.source", "n_rows", "size", "source_size", "target", "whole",
        (F.col("certain") + F.coalesce("extra", F.lit(0))).alias("more"),
    )


def copies(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """How often the mix takes each document.

    Columns: doc_id, text_key, source, n_rows, size, source_size, target, copies: ``n_rows`` rows
    with this doc_id, text and source are taken ``copies`` times each. Of rows that repeat all
    three, as many as their rate says for certain are taken once more than the others, and only
    what is left of one row is rounded; such rows give two results, one for each number of
    copies. A null text has size 0; a document without words is taken 0 times if its
    fraction is not whole, and counts for nothing; a null source is a source of its own, the
    last; an empty table gives no rows; other columns are ignored.
    """
    groups = F.array(
        F.struct(F.col("more").alias("n_rows"), (F.col("whole") + 1).alias("copies")),
        F.struct((F.col("n_rows") - F.col("more")).alias("n_rows"), F.col("whole").alias("copies")),
    )
    parts = _plan(docs, weights, most).withColumn(
        "part", F.explode(F.filter(groups, lambda g: g["n_rows"] > 0))
    )
    return parts.select(
        "doc_id", "text_key", "source", "part.n_rows", "size", "source_size", "target", "part.copies"
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (its words in the mix)."""
    taken = (F.col("size") * F.col("copies")).alias("taken")
    # In runs, so that no array grows with the number of equal rows.
    runs = copies(docs, **options).withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_rows - 1) div {RUN}")))
    )
    here = F.least(F.lit(RUN).cast("bigint"), F.col("n_rows") - F.col("run") * RUN)
    rows = runs.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), here)))
    return rows.select("doc_id", "size", "source_size", "target", taken)


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the same columns.

    Own columns may have any names. Where only some of the rows with one doc_id, text and source
    are taken once more, these are the first by a hash of the whole row.
    """
    unit = ["source", "doc_id", "text_key"]
    plan = written(_plan(docs, weights, most), "mixing-plan")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    texts = docs.select(row, "source", "doc_id", F.xxhash64("text").alias("text_key"))
    same = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in unit])
    # The whole part is the source's; which units are taken once more is told without moving texts.
    whole = broadcast_if_few(plan.groupBy("source").agg(F.max("whole").alias("whole")))
    once_more = F.col("more") == F.col("n_rows")
    texts = told(texts, plan.where(once_more), plan.where(~once_more), unit)
    texts = texts.alias("d").join(whole.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    texts = texts.select("d.*", "whole")
    each = (F.col("whole") + F.col("has").cast("bigint")).alias("copies")
    uneven = plan.where((F.col("more") > 0) & ~once_more)
    if uneven.isEmpty():
        kept = texts.select("row", each)
    else:
        found = marked(texts, uneven, unit)
        some = found.where("maybe").alias("d")
        kept = found.where("NOT maybe").select("row", each)
        kept = kept.unionAll(some.join(uneven.alias("p"), same, "left_anti").select("row", each))
        rows = some.join(uneven.alias("p"), same).select("d.row", *[f"d.{c}" for c in unit], "d.whole", "more")
        # Equal rows may swap their places, so any order among them will do.
        rows = rows.withColumns({"by": F.xxhash64("row"), "tie": F.monotonically_increasing_id()})
        rows = running_count(rows, unit, ["by", "tie"])
        each = F.col("whole") + (F.col("rn") <= F.col("more")).cast("bigint")
        kept = kept.unionAll(rows.select("row", each.alias("copies")))
    kept = kept.where("copies > 0")
    repeat = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return kept.select("row", repeat.alias("copy")).select("row.*")
