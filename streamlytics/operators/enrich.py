"""Lookups against a rule table that is read again for every micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A lookup side of at most this many bytes is sent to every executor.
FEW_BYTES = 32 << 20
_ROW_BYTES = 16


def broadcast_if_few(side: DataFrame, max_bytes: int = FEW_BYTES) -> DataFrame:
    """Hint a broadcast if the side is measured to be small; leave it to a shuffle join if not.

    Without the hint, Spark may shuffle the large side before it learns how small this one is.
    No more rows are read than could be small.
    """
    long = [f.name for f in side.schema.fields if f.dataType.typeName() in ("string", "binary")]
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c in long]
    row = sum(text, F.lit(_ROW_BYTES + 8 * len(side.columns)))
    read = side.limit(max_bytes // _ROW_BYTES + 1)
    size = read.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0))).first()[0]
    return F.broadcast(side) if size <= max_bytes else side


def match_rules(df: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Every row plus the rule it hits and whether it hits one. Rule keys are unique."""
    hit = rules.select(key, "rule", F.lit(True).alias("matched"))
    joined = df.join(hit, key, "left")
    return joined.select(*df.columns, "rule", F.coalesce("matched", F.lit(False)).alias("matched"))


def refreshed_lookup(
    load_rules: Callable[[int], DataFrame], key: str, write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: load the rules for the batch id, match, hand the result on.

    The batch id makes a repeated batch get the rules it had.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        write(match_rules(batch, load_rules(batch_id), key), batch_id)

    return apply
