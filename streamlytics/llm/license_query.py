"""Query of the license scan. Tests compare it with a plain version on a small table."""

from streamlytics.llm.common import query, table
from streamlytics.llm.licenses import licenses


@query("op6_patience_licenses")
def op6(spark, sf_dir):
    return licenses(table(spark, sf_dir, "documents"))
