"""Which rows may have a key of a smaller table, told before their texts move.

Every key of the table sets one of ``WORDS * 64`` bits, and the bits are sent to all executors. A row
whose bit is not set has none of the keys for sure; the others still have to be joined. However
many keys there are, the bits stay ``WORDS`` rows; more keys only leave more rows to the join.

Where all keys of the rows are known as well, ``told`` needs no such join: keys that the bits mistake are
found beforehand without the texts, and their own bits set them right, until few are left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import written
from streamlytics.operators.enrich import FEW_BYTES, broadcast_if_few

WORDS = 1 << 19
#: Tables of bits, each for the keys that the one before mistakes.
LEVELS = 4


def _place(columns: list[str], level: int) -> tuple[Column, Column]:
    """Word and bit of a key, nulls included; others on each level."""
    drawn = F.xxhash64(F.lit(f"key filter {level}" if level else "key filter"), *columns)
    return F.pmod(drawn, F.lit(WORDS)), F.pmod(F.shiftrightunsigned(drawn, 40), F.lit(64)).cast("int")


def marked(df: DataFrame, keys: DataFrame, columns: list[str], level: int = 0) -> DataFrame:
    """``df`` with ``maybe``: false where no row of ``keys`` has the same ``columns``.

    ``keys`` should be a stored table, as it is read here and by the join that follows.
    """
    word, bit = _place(columns, level)
    one = F.lit(1).cast("bigint")
    set_bits = keys.select(word.alias("_word"), F.call_function("shiftleft", one, bit).alias("_bits"))
    set_bits = set_bits.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    found = F.call_function("shiftright", F.coalesce("_bits", F.lit(0).cast("bigint")), bit).bitwiseAND(one)
    joined = df.withColumn("_word", word).join(F.broadcast(set_bits), "_word", "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (found == 1).alias("maybe"))


def told(df: DataFrame, keys: DataFrame, others: DataFrame, columns: list[str], few: int = FEW_BYTES) -> DataFrame:
    """``df`` with ``has``: whether a row of ``keys`` has the same ``columns``.

    ``others`` has all further keys of ``df``'s rows. Both are stored tables. Rows of ``df`` are moved only where
    mistaken keys are more than ``few`` bytes after ``LEVELS`` tables of bits.
    """
    inside, outside = keys.select(*columns), others.select(*columns)
    found = df
    passed = []
    for level in range(LEVELS):
        found = marked(found, inside, columns, level).withColumnRenamed("maybe", f"_maybe_{level}")
        passed.append(F.col(f"_maybe_{level}"))
        # Keys of the other side that these bits take for their own.
        mistaken = marked(outside, inside, columns, level).where("maybe").select(*columns).distinct()
        inside, outside = written(mistaken, "key-filter"), inside
        last = broadcast_if_few(inside, few)
        if last is not inside:
            break
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in columns]
    last = last.withColumn("_last", F.lit(True)).alias("m")
    found = found.alias("d").join(last, reduce(lambda a, b: a & b, same), "left")
    has = F.col("_last").isNotNull()
    for here in reversed(passed):
        has = here & ~has
    return found.select(*[F.col(f"d.`{c}`") for c in df.columns], has.alias("has"))
