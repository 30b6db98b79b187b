"""Query of the document fingerprints. Tests compare it with a plain version on a small table."""

from streamlytics.llm.common import query, table
from streamlytics.llm.rare_features import fingerprinted


@query("op2_rare_feature_prints")
def op2(spark, sf_dir):
    return fingerprinted(table(spark, sf_dir, "documents"))
