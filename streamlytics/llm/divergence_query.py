"""Query and SQL of the source divergence audit."""

from streamlytics.llm.common import query, table
from streamlytics.llm.divergence import audit

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_P = "1 + (1000000000::HUGEINT * ({count} + 2)) // ({total} + 2 * v)"
_F = "(({p} - {q}) * ({p} - {q})) // ({p} + {q})"

SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text FROM documents),
words AS (
    SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 10),
cells AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
langs AS (
    SELECT l.lang, count(k.term)::HUGEINT AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept k USING (lang)
    GROUP BY ALL),
totals AS (
    SELECT g.lang, g.source, v, coalesce(sum(n), 0)::HUGEINT AS total
    FROM groups g JOIN langs USING (lang) LEFT JOIN cells c USING (lang, source) GROUP BY ALL),
lang_cells AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM cells GROUP BY ALL),
lang_totals AS (SELECT lang, sum(n)::HUGEINT AS total FROM lang_cells GROUP BY ALL),
p AS (
    SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, {_P.format(count="coalesce(c.n, 0)", total="t.total")} AS p,
        {_P.format(count="a.n", total="lt.total")} AS q
    FROM totals t JOIN kept k USING (lang) JOIN lang_cells a USING (lang, term)
    JOIN lang_totals lt USING (lang) LEFT JOIN cells c USING (lang, source, term)),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce((SELECT sum({_F.format(p="x.p", q="y.p")}) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
            WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    UNION ALL
    SELECT lang, source, 'term', term, ({_F.format(p="p", q="q")})::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op12_source_divergence", SQL)
def op12(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))
