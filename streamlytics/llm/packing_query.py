"""Query of the packing. Tests compare it with a plain version on a small table."""

from pathlib import Path

from pyspark.sql import functions as F

from streamlytics.llm.common import query, table
from streamlytics.llm.packing import packed

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


@query("op11_concat_and_cut")
def op11(spark, sf_dir):
    found = packed(table(spark, sf_dir, "documents"), Path(TOKENIZER).read_text())
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
