"""Query and SQL of the fill-in-middle transformation."""

from pyspark.sql import functions as F

from streamlytics.llm.common import query, table
from streamlytics.llm.fim import fill_in_middle, restored


def _draw(i: int) -> str:
    """Eight hexadecimal digits as a number."""
    digits = [
        f"(instr('0123456789abcdef', substr(h, {8 * i + k + 1}, 1)) - 1)::BIGINT * {16 ** (7 - k)}"
        for k in range(8)
    ]
    return " + ".join(digits)


SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT *, {_draw(0)} AS h1, {_draw(1)} AS h2, {_draw(2)} AS h3, {_draw(3)} AS h4 FROM d),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (
    SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m,
        substring(text, b + 1, n - b) AS s FROM cut)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_skip_list_fim", SQL)
def op13(spark, sf_dir):
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )
