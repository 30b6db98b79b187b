"""Run a query and its SQL side by side."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, sf_dir, fn, sql) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got_names, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want_names, want = _sorted(names, cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        extra = list(dict.fromkeys(r for r in got if r not in set(want)))[:3]
        missing = list(dict.fromkeys(r for r in want if r not in set(got)))[:3]
        return f"{len(got)} rows != {len(want)}; only spark {extra}; only sql {missing}"
    types = [type(x).__name__ for x in (got[0] if got else ())]
    want_types = [type(x).__name__ for x in (want[0] if want else ())]
    return None if types == want_types else f"types {types} != {want_types}"
