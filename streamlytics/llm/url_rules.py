"""Allow and block rules for URLs by hashed expressions.

A URL is expanded into every suffix of its host joined with every prefix of its path whose length
some rule has. Expressions and rules meet on the first 32 bits of a digest, which keeps the join
key short; the full digest confirms a hit, and the longest rule that fits decides.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT_HEX = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host is lower-cased A-Z; both are empty without '://' (or without a URL)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    parts = r"^([^/?#]*)([^?#]*)"
    host = F.translate(
        F.regexp_extract(rest, parts, 1), string.ascii_uppercase, string.ascii_lowercase
    )
    return host, F.regexp_extract(rest, parts, 2)


def _joined(host: Column, path: Column) -> Column:
    """One text per pair of host and path: the length tells a.co + m/ from a.com + /."""
    return F.concat(F.length(host).cast("string"), F.lit(":"), host, path)


def _expressions(lengths: list[int]) -> Column:
    """Host suffixes times path prefixes, as one array of strings that say where the host ends."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _joined(s, p))))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """The rows of ``pages`` with host, path, rule and verdict added (their own are replaced).

    ``rules`` has host, path and action. A rule fits its host and all its subdomains if the URL's
    path starts with the rule's; of several, the longest ``host + path`` wins, and of equal ones
    'block'. Without a rule the verdict is ``default``. Defined cases: a null URL, or one without
    '://', has an empty host and path and meets no rule; repeated rows are judged alike; rules
    with a null or an empty host fit nothing, a null rule path is an empty one.
    """
    host, path = host_and_path(F.col(url))
    added = ["host", "path", "rule", "verdict"]
    own = [c for c in pages.columns if c not in added]
    known = rules.where("host <> ''").select(
        F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"),
        _joined(F.col("host"), F.coalesce("path", F.lit(""))).alias("joined"),
        F.length(F.coalesce("path", F.lit(""))).alias("n_path"),
        "action",
    )
    # As many as rule paths have lengths, however many rules there are.
    lengths = sorted(r[0] for r in known.select("n_path").distinct().collect())
    known = known.select(
        F.sha2("joined", 256).alias("digest"),
        F.substring(F.sha2("joined", 256), 1, SHORT_HEX).alias("short"),
        F.struct(F.length("rule").alias("size"), "action", "rule").alias("hit"),
    )
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
        host.alias("host"),
        path.alias("path"),
        F.monotonically_increasing_id().alias("at"),
    )
    asked = rows.withColumn(
        "expression", F.explode_outer(_expressions(lengths) if lengths else F.array().cast("array<string>"))
    )
    asked = asked.withColumn("digest", F.sha2("expression", 256)).drop("expression")
    asked = asked.withColumn("short", F.substring("digest", 1, SHORT_HEX))
    confirmed = F.when(F.col("a.digest") == F.col("k.digest"), F.col("k.hit"))
    best = (
        asked.alias("a")
        .join(known.alias("k"), "short", "left")
        .select("at", "row", "host", "path", confirmed.alias("hit"))
        .groupBy("at")
        .agg(
            F.first("row").alias("row"),
            F.first("host").alias("host"),
            F.first("path").alias("path"),
            F.max("hit").alias("hit"),
        )
    )
    return best.select(
        *[F.col(f"row.`{c}`").alias(c) for c in own],
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.action", F.lit(default)).alias("verdict"),
    )
