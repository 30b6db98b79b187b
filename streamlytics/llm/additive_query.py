"""Query of the quality classifier. Tests check its accuracy on held-out documents."""

from pyspark.sql import functions as F

from streamlytics.llm.additive import scored, train
from streamlytics.llm.common import query, table

FOLDS, HELD_OUT = 3, 1


def in_held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


@query("op9_additive_quality")
def op9(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~in_held_out()))
    return scored(docs, model).select(
        "doc_id",
        in_held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
