"""Word counts and text sources."""

from pyspark.sql import functions as F

from streamlytics.functions.text import words_of
from streamlytics.operators import aggregate as agg
from streamlytics.plans import views as v
from streamlytics.plans.registry import query
from streamlytics.session import scratch
from streamlytics.sources.tables import catalog_table, head, text_lines
from streamlytics.streaming.sinks import replace_table

WORDS = "conv_lines words"
PLACE = ["conv_id", "turn", "line_no", "pos"]


@query("flatmap_words", "SELECT conv_id, turn, line_no, pos, word FROM words", WORDS)
def flatmap_words(spark, d):
    return v.words(spark, d)


@query(
    "flatmap_words_nonempty",
    "SELECT conv_id, turn, line_no, pos, word FROM words WHERE word <> ''",
    WORDS,
)
def flatmap_words_nonempty(spark, d):
    return v.words(spark, d, drop_empty=True)


@query(
    "word_count_batch",
    "SELECT word, count(*) AS count FROM document_words GROUP BY word",
    "document_words",
)
def word_count_batch(spark, d):
    return agg.word_count(v.document_words(spark, d))


@query(
    "running_word_count",
    """SELECT conv_id, turn, line_no, pos, word, count(*) OVER (PARTITION BY word
    ORDER BY conv_id, turn, line_no, pos ROWS UNBOUNDED PRECEDING) AS count FROM words""",
    WORDS,
)
def running_word_count(spark, d):
    return agg.running_word_count(v.words(spark, d), PLACE)


@query(
    "src_jdbc_pushdown",
    "SELECT word, count(*) AS count FROM document_words WHERE word = 'the' GROUP BY word",
    "document_words",
)
def word_count_filtered(spark, d):
    """The pushed-down condition, on the word-count table: the filter moves below the count."""
    return agg.word_count(v.document_words(spark, d)).where("word = 'the'")


@query(
    "src_catalog_table",
    """SELECT word, count(*) AS count FROM document_words GROUP BY word
    ORDER BY count(*) DESC, word LIMIT 100""",
    "document_words",
)
def src_catalog_table(spark, d):
    """A stored catalog table, read by its name."""
    replace_table(agg.word_count(v.document_words(spark, d)), "streamlytics_words", scratch(spark, "words"))
    return head(catalog_table(spark, "streamlytics_words"), [F.desc("count"), "word"], 100)


@query(
    "order_limit",
    """SELECT conv_id, turn, role, length(text) AS n FROM conversations
    ORDER BY n DESC, conv_id, turn LIMIT 10""",
)
def order_limit(spark, d):
    t = v.table(spark, d, "conversations").select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("n")
    )
    return head(t, [F.desc("n"), "conv_id", "turn"], 10)


@query(
    "src_text_lines",
    "SELECT word, count(*) AS count FROM words GROUP BY word",
    WORDS,
)
def src_text_lines(spark, d):
    """Lines written as text files and read back through the text source."""
    path = scratch(spark, "text")
    v.lines(spark, d).select("line").write.text(path)
    read = text_lines(spark, path).select(F.explode(words_of(F.col("value"))).alias("word"))
    return agg.word_count(read)
