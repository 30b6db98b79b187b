"""Query of the source mix. Random rounding has no SQL; tests compare it with a plain version."""

from streamlytics.llm.common import query, table
from streamlytics.llm.mixing import mix_report


@query("op5_pivotal_mix")
def op5(spark, sf_dir):
    return mix_report(table(spark, sf_dir, "documents"))
