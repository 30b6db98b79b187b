"""Shards of bounded size by extendible hashing.

A document's key is 60 bits of a digest. The directory starts as one bucket; a bucket that holds
more bytes than the limit, and more than one key, splits on the next bit, and no other bucket
does. So a shard is the shortest prefix of its keys whose bytes fit.

Splits are worked out ``ROUND_BITS`` bits at a time on sums per prefix, which combine before the
shuffle; only keys below a prefix that is still too large go on to the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import written
from streamlytics.operators.ordered import running_count

KEY_BITS = 60
ROUND_BITS = 12
#: Small, so that small tables split as well; files of a large corpus would take 256 MiB.
SHARD_BYTES = 1 << 20
#: Leaves that may be sent to every executor, some 48 bytes each.
FEW_LEAVES = 1 << 19


def _key() -> Column:
    """The leading bits of a digest of doc_id and text."""
    named = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit(":"),
        F.coalesce("text", F.lit("")),
    )
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def _keys(docs: DataFrame) -> DataFrame:
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return docs.select("doc_id", n_bytes.alias("n_bytes"), _key().alias("key"))


def _round(rows: DataFrame, base: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Leaves with ``base`` to ``base + ROUND_BITS`` bits, and the nodes still too large below."""
    deep = base + ROUND_BITS
    cells = rows.groupBy(F.shiftright("key", KEY_BITS - deep).alias("cell")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    nodes = written(
        cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(deep))))
        .groupBy("depth", F.expr(f"shiftright(cell, {deep} - depth)").alias("prefix"))
        .agg(F.sum("n_bytes").alias("shard_bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("splits", (F.col("shard_bytes") > limit) & (F.col("low") < F.col("high"))),
        "sharding-nodes",
    )
    parents = nodes.where("splits").select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
    )
    below = nodes.withColumn("parent", F.shiftright("prefix", 1)).join(
        parents, ["depth", "parent"], "left_semi"
    )
    # Only the root has no parent; the first node of a later round is known to split.
    leaves = below.unionByName(
        nodes.where(F.col("depth") == base).withColumn("parent", F.shiftright("prefix", 1))
    ).where("NOT splits")
    return leaves.drop("splits", "parent"), nodes.where(F.col("splits") & (F.col("depth") == deep))


def _split(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their leaf, and the leaves: (depth, prefix, shard_bytes, single)."""
    found, ends, left = [], [], rows
    for base in range(0, KEY_BITS, ROUND_BITS):
        deep = base + ROUND_BITS
        leaves, large = _round(left, base, limit)
        leaves = leaves.select(
            "depth", "prefix", "shard_bytes", (F.col("low") == F.col("high")).alias("single")
        )
        ends.append(leaves)
        # Leaves are fewer than cells, and cells at most one per row: map cells, then rows.
        cell = F.shiftright("key", KEY_BITS - deep).alias("cell")
        cells = left.select(cell).distinct()
        spots = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(deep)))).withColumn(
            "prefix", F.expr(f"shiftright(cell, {deep} - depth)")
        )
        homes = spots.join(leaves, ["depth", "prefix"]).select(
            "cell", "depth", "prefix", "shard_bytes", "single"
        )
        found.append(left.withColumn("cell", cell).join(homes, "cell").drop("cell"))
        if large.isEmpty():
            break
        below = large.select(F.col("prefix").alias("cell"))
        left = written(
            left.withColumn("cell", cell).join(below, "cell", "left_semi").drop("cell"),
            "sharding-left",
        )
    return reduce(DataFrame.unionAll, found), reduce(DataFrame.unionAll, ends)


def _bits() -> Column:
    """The name of a leaf: its prefix as binary digits."""
    return F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))
    )


def _spread_copies(rows: DataFrame, limit: int) -> DataFrame:
    """Split shards that hold too many copies of one row: no bit tells those apart."""
    per = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(limit) / F.col("n_bytes")))
    grouped = rows.groupBy("doc_id", "n_bytes", "key", "shard", "depth").agg(
        F.count("*").alias("n_rows")
    )
    parts = grouped.withColumn("per", per).withColumn(
        "part",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n_rows") / F.col("per")) - 1)),
    )
    here = F.least(F.col("per"), F.col("n_rows") - F.col("part") * F.col("per"))
    parts = parts.withColumn("here", here)
    return parts.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "here"))).select(
        "doc_id",
        "n_bytes",
        "key",
        F.concat_ws(".", "shard", "part").alias("shard"),
        "depth",
        (F.col("n_bytes") * F.col("here")).alias("shard_bytes"),
    )


def sharded(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, key, shard, depth, shard_bytes.

    ``shard`` is the bucket's bit prefix ('' if all fit one), ``depth`` its length. Every shard
    holds at most ``limit`` bytes of text, unless it is one document larger than that, which gets
    a shard of its own. Defined cases: a null text has 0 bytes; a null doc_id counts as an empty
    name; rows equal in doc_id and text have one key, and where their copies exceed the limit the
    shard is dealt into parts named ``prefix.0``, ``prefix.1`` and so on; an empty table gives no
    rows; other columns are ignored.
    """
    rows = written(_keys(docs), "sharding-keys")
    placed = _split(rows, limit)[0].withColumn("shard", _bits()).drop("prefix")
    heavy = (F.col("shard_bytes") > limit) & F.col("single") & (F.col("n_bytes") < F.col("shard_bytes"))
    columns = ["doc_id", "n_bytes", "key", "shard", "depth", "shard_bytes"]
    crowded = placed.where(heavy)
    if crowded.isEmpty():
        return placed.select(*columns)
    spread = _spread_copies(crowded, limit).select(*columns)
    return placed.where(~heavy).select(*columns).union(spread)


def with_shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs`` with their ``shard``, which takes the place of an own column of that name.

    Copies of one row that are dealt into parts are numbered, so that every part holds as many as fit.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "shard"]).alias("row")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    rows = docs.select(row, _key().alias("key"), n_bytes)
    keys = written(_keys(docs), "sharding-keys")
    homes, leaves = _split(keys, limit)
    leaves = written(leaves, "sharding-leaves")
    if leaves.limit(FEW_LEAVES + 1).count() > FEW_LEAVES:
        homes = homes.select("key", "depth", "prefix", "shard_bytes", "single").distinct()
        at_home = rows.join(homes, "key")
    else:
        # Texts stay where they are: a row meets its leaf at one of the few depths there are.
        depths = [F.lit(r["depth"]) for r in leaves.select("depth").distinct().collect()]
        spots = rows.withColumn("depth", F.explode(F.array(*depths).cast("array<int>")))
        spots = spots.withColumn("prefix", F.expr(f"shiftright(key, {KEY_BITS} - depth)"))
        at_home = spots.join(F.broadcast(leaves), ["depth", "prefix"])
    large = (F.col("shard_bytes") > limit) & F.col("single")
    dealt = large & (F.col("n_bytes") < F.col("shard_bytes"))
    placed = at_home.where(~dealt).select("row.*", _bits().alias("shard"))
    if leaves.where(large).isEmpty():
        return placed
    some = at_home.where(dealt).withColumn("at", F.monotonically_increasing_id())
    per = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(limit) / F.col("n_bytes")))
    part = F.floor((F.col("rn") - 1) / per)
    some = running_count(some, ["key"], ["at"])
    return placed.union(some.select("row.*", F.concat_ws(".", _bits(), part).alias("shard")))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write the rows of ``docs`` as Parquet, one folder per shard; an own column ``shard`` goes."""
    with_shards(docs, limit).repartition("shard").write.partitionBy("shard").parquet(path)
