"""Query of the toxicity chain. Tests check its accuracy on held-out documents."""

from pyspark.sql import functions as F

from streamlytics.llm.common import query, table
from streamlytics.llm.toxicity import judged, sampled_labels, train

#: The labels know one mark, so the categories are toxic English, toxic other text, and toxic.
CATEGORIES = ["toxic_en", "toxic_other", "toxic_any"]


def labelled(docs, labels):
    """Sampled labelled documents with a 0/1 column per category; the language is used here only."""
    known = sampled_labels(labels.where(F.col("toxic").isNotNull()).select("doc_id", "toxic"))
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    toxic = F.col("toxic") == 1
    return docs.select("doc_id", "text", "lang").join(F.broadcast(known), "doc_id").select(
        "doc_id",
        "text",
        (toxic & english).cast("int").alias("toxic_en"),
        (toxic & ~english).cast("int").alias("toxic_other"),
        toxic.cast("int").alias("toxic_any"),
    )


def fitted(spark, docs, sf_dir):
    return train(labelled(docs, table(spark, sf_dir, "labels")), CATEGORIES)


@query("op10_toxicity_chain")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return judged(docs, fitted(spark, docs, sf_dir))
