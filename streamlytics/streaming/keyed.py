"""Keyed tables: what streams merge their batches into.

A batch adds one Parquet folder named by its batch id, so its cost is the batch, not the
table, and running it again replaces its own folder and nothing else. Reading folds the
folders by key. ``compact`` folds them into a base now and then, which bounds a read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Fold = Callable[[DataFrame, list[str], list[str]], DataFrame]


def keep_latest(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Put: the value of the newest batch wins."""
    newest = F.max_by(F.struct(*values), "_batch").alias("_v")
    return rows.groupBy(*keys).agg(newest, F.max("_batch").alias("_batch")).select(
        *keys, "_v.*", "_batch"
    )


def add_up(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Increment: batches hold deltas."""
    return rows.groupBy(*keys).agg(
        *[F.sum(v).alias(v) for v in values], F.max("_batch").alias("_batch")
    )


def collect_members(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Set add."""
    return rows.groupBy(*keys).agg(F.max("_batch").alias("_batch"))


def keep_all(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """For keys that come once: nothing to fold, so nothing is shuffled."""
    return rows


def same(columns: list[str], left: str, right: str) -> Column:
    """Equal in all ``columns``, nulls included, between two aliased frames."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    )


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        schema: str,
        fold: Fold | None = keep_latest,
        parts: tuple[str, ...] = (),
    ):
        """``schema`` is the DDL of keys and values. ``fold=None`` replaces the whole content
        with each batch. ``parts`` are key columns the folders are split by, so that a read
        of a few of their values leaves out the rest."""
        self.spark, self.path, self.keys, self.fold = spark, path, keys, fold
        self.parts = parts
        self.stored = T.StructType.fromDDL(f"{schema}, _batch BIGINT")
        self.columns = self.stored.names[:-1]
        self.values = [c for c in self.columns if c not in keys]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``batch`` holds at most one row per key."""
        marked = batch.select(*self.columns).withColumn("_batch", F.lit(batch_id).cast("bigint"))
        self._save(marked, f"log/batch={batch_id}")

    def _save(self, rows: DataFrame, folder: str) -> None:
        if self.parts:
            rows = rows.hint("rebalance", *self.parts)
        rows.write.mode("overwrite").partitionBy(*self.parts).parquet(f"{self.path}/{folder}")

    def _folder(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return path, path.getFileSystem(conf)

    def _finished(self, kind: str) -> list[int]:
        """Ids of the completely written folders, ascending."""
        root, fs = self._folder(kind)
        if not fs.exists(root):
            return []
        marker = self.spark._jvm.org.apache.hadoop.fs.Path
        paths = [status.getPath() for status in fs.listStatus(root)]
        return sorted(
            int(p.getName().split("=")[1]) for p in paths if fs.exists(marker(p, "_SUCCESS"))
        )

    def _load(self, kind: str, names: list[str]) -> DataFrame:
        """Folders of one kind; the kind's folder is where partition columns start."""
        root = f"{self.path}/{kind}"
        reader = self.spark.read.schema(self.stored).option("basePath", root)
        return reader.parquet(*[f"{root}/{n}" for n in names]).select(*self.stored.names)

    def _rows(self, before: int | None) -> DataFrame:
        logs = [b for b in self._finished("log") if before is None or b < before]
        found = []
        if self.fold is None:
            logs = logs[-1:]
        else:
            bases = [b for b in self._finished("base") if before is None or b < before]
            if bases:
                logs = [b for b in logs if b > bases[-1]]
                found.append(self._load("base", [f"upto={bases[-1]}"]))
        if logs:
            found.append(self._load("log", [f"batch={b}" for b in logs]))
        if not found:
            nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.stored]
            return self.spark.range(0).select(*nulls)
        return reduce(DataFrame.unionByName, found)

    def read(
        self,
        before: int | None = None,
        where: Column | None = None,
        only: DataFrame | None = None,
    ) -> DataFrame:
        """The content, or what it was before batch ``before`` – which makes that batch
        repeatable. ``where`` is a condition on keys, applied to the scan; ``only`` holds values of
        some keys, and rows without a match in it are left out before anything is folded."""
        rows = self._rows(before)
        if where is not None:
            rows = rows.where(where)
        if only is not None:
            rows = rows.alias("s").join(only.alias("o"), same(only.columns, "s", "o"), "left_semi")
        if self.fold is not None:
            rows = self.fold(rows, self.keys, self.values)
        return rows.select(*self.columns)

    def batch(self, batch_id: int) -> DataFrame:
        """What one batch wrote."""
        return self._load("log", [f"batch={batch_id}"]).select(*self.columns)

    def compact(self, upto: int, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Fold everything up to batch ``upto`` into a base. ``keep`` leaves out rows of it that no
        later batch can need.

        What the base before it covers is removed. The folders since then stay, for a batch
        that is repeated and for readers that still hold a file list.
        """
        if self.fold is None:
            return
        old = [b for b in self._finished("base") if b < upto]
        folded = self.fold(self._rows(upto + 1), self.keys, self.values)
        if keep is not None:
            folded = keep(folded)
        self._save(folded, f"base/upto={upto}")
        if old:
            covered = [f"log/batch={b}" for b in self._finished("log") if b <= old[-1]]
            for name in covered + [f"base/upto={b}" for b in old[:-1]]:
                path, fs = self._folder(name)
                fs.delete(path, True)
