"""Query and SQL of the URL rules."""

from streamlytics.llm.common import query, table
from streamlytics.llm.url_rules import judge_urls

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

SQL = f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {", ".join(map(str, RULES))}),
rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END
        AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
parts AS (
    SELECT page_id,
        translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM hosts),
best AS (
    SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(action, length(rule_host || rule_path)) AS action
    FROM parts JOIN rules ON starts_with(path, rule_path)
        AND (host = rule_host OR ends_with(host, '.' || rule_host))
    GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN best USING (page_id)
"""


@query("op1_url_rules", SQL)
def op1(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")
