"""A documents table with everything awkward in it."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, rank int"
BIG = 2**62 + 1
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank.", "en", "a", 10, "k", 1),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank.", "en", "b", 10, "k", 1),
    (3, None, "en", "a", None, None, None),
    (4, "", None, None, 0, "k", 2),
    (5, "  \t\n ", "de", "b", 5, "k", 2),
    (6, LONG, "en", "a", len(LONG), "k", 3),
    (7, "one two", "en", "a", 7, "k", 3),
    (7, "one two", "en", "a", 7, "k", 3),
    (7, "another text under the same number", "en", "c", 7, "k", 3),
    (None, "a text without any number of its own", "en", None, 7, "k", 3),
    (None, "a text without any number of its own", "en", None, 7, "k", 4),
    (BIG, "a number that no float holds, Straße ÄÖÜ 漢字 emoji 😀 end", "de", "c", 7, "k", 3),
]


def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return docs(spark).where(F.lit(False))
