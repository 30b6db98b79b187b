"""Query and SQL of the sharding operator."""

from streamlytics.llm.common import query, table
from streamlytics.llm.sharding import KEY_BITS, SHARD_BYTES, sharded

SQL = f"""
WITH keys AS (
    SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT
            AS key
    FROM documents),
nodes AS (
    SELECT d, key >> ({KEY_BITS} - d) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes,
        min(key) = max(key) AS single
    FROM keys, range(0, {KEY_BITS + 1}) r(d) GROUP BY ALL),
depths AS (
    SELECT key, min(d) AS d FROM keys, nodes
    WHERE prefix = key >> ({KEY_BITS} - d) AND (shard_bytes <= {SHARD_BYTES} OR single)
    GROUP BY key)
SELECT doc_id, n_bytes,
    CASE WHEN d = 0 THEN '' ELSE lpad(bin(key >> ({KEY_BITS} - d)), d::INTEGER, '0') END AS shard,
    d::INTEGER AS depth, shard_bytes
FROM keys JOIN depths USING (key) JOIN nodes USING (d)
WHERE prefix = key >> ({KEY_BITS} - d)
"""


@query("op8_extendible_shards", SQL)
def op8(spark, sf_dir):
    return sharded(table(spark, sf_dir, "documents")).drop("key")
