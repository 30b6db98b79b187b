"""Query and SQL of the near-duplicate join."""

from streamlytics.llm.chosen_path import near_duplicates
from streamlytics.llm.common import query, table

# Every pair of documents that shares a shingle is counted, so this is for small tables.
SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    END) AS s FROM words),
flat AS (SELECT doc_id, unnest(s) AS g FROM sets),
many AS (SELECT g FROM flat GROUP BY g HAVING count(*) > 1),
shared AS MATERIALIZED (SELECT doc_id, g FROM flat SEMI JOIN many USING (g)),
pairs AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM shared a JOIN shared b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
    SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * n_both >= 75 * (len(x.s) + len(y.s) - n_both)),
steps AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, s.b FROM reach r JOIN steps s ON s.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""


@query("op7_chosen_path_near_dups", SQL)
def op7(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )
