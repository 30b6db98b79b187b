"""Query of the benchmark leaks. Tests compare it with a plain version on a small table."""

from streamlytics.llm.common import query, table
from streamlytics.llm.decontaminate import leaks


@query("op3_template_leaks")
def op3(spark, sf_dir):
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), any_case=True)
    return found.drop("text_key")
