"""String helpers whose edge cases follow Java's ``String`` methods."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_fields(text: Column, delimiter: str) -> Column:
    """Split on a literal delimiter and drop trailing empty fields.

    Spark's ``split`` keeps them. Leading and inner empties stay, an empty text gives one
    empty field, and a text of nothing but delimiters gives none.
    """
    literal = re.escape(delimiter)
    if len(delimiter) == 1:
        kept = F.rtrim(text, F.lit(delimiter))
    else:
        kept = F.regexp_replace(text, f"(?:{literal})+\\z", "")
    empty = F.array().cast("array<string>")
    return F.when((kept == "") & (text != ""), empty).otherwise(F.split(kept, literal, -1))


def words_of(line: Column) -> Column:
    return split_fields(line, " ")


def contains_text(text: Column, needle: str) -> Column:
    return F.coalesce(F.contains(text, F.lit(needle)), F.lit(False))


def composite_key(*parts: Column | str) -> Column:
    return F.concat_ws(":", *parts)


def key_part(key: Column | str, position: int) -> Column:
    """Part of a composite key, counted from zero; wrong if a part itself holds ``:``."""
    return F.split(F.col(key) if isinstance(key, str) else key, ":", -1).getItem(position)


def text_map(names: list[str]) -> Column:
    """name -> value, every value as text."""
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
    return F.create_map(*pairs)


def text_json(**fields: Column) -> Column:
    """A JSON object whose values are all strings."""
    return F.to_json(F.struct(*[c.cast("string").alias(n) for n, c in fields.items()]))
