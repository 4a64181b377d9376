"""Queries of the operators that use DataFrame functions alone: fingerprints and URL filters."""

from __future__ import annotations

from reportlake.llm import fingerprints, url_filter
from reportlake.llm.registry import query, table


def _rounds_sql() -> str:
    """The propagation rounds, one CTE each."""
    d, out = url_filter.DAMPING, []
    for k in range(url_filter.ROUNDS):
        out.append(f"""r{k + 1} AS (SELECT kind, host, sum(score) AS score FROM (
    SELECT s.kind, s.dst AS host, {d} * n.score * s.share AS score FROM steps s JOIN r{k} n ON s.kind = n.kind AND s.host = n.host
    UNION ALL SELECT kind, host, (1 - {d}) * score FROM r0) GROUP BY kind, host)""")
    return ",\n".join(out)


OP3_SQL = rf"""
WITH parts AS (SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
ruled AS (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts),
judged AS (SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled FROM ruled),
r0 AS (SELECT * FROM (
    SELECT 'trust' AS kind, host, avg(CASE WHEN ruled = 'allow' THEN 1.0 ELSE 0.0 END) AS score FROM judged WHERE host <> '' GROUP BY host
    UNION ALL SELECT 'distrust', host, avg(CASE WHEN ruled = 'block' THEN 1.0 ELSE 0.0 END) FROM judged WHERE host <> '' GROUP BY host) WHERE score > 0),
links AS (SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight FROM (SELECT DISTINCT page_id, src, lower(dst) AS dst FROM (
    SELECT page_id, host AS src, unnest(regexp_extract_all(html, '(?i)(?:href|src)\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^"''\s>/?#]*)', 1)) AS dst FROM judged WHERE host <> ''))
    WHERE dst <> '' AND src <> dst GROUP BY src, dst),
hosts AS (SELECT DISTINCT host FROM (SELECT host FROM judged UNION SELECT dst FROM links)),
labels AS (SELECT string_split(host, '.') AS l FROM hosts),
parents AS (SELECT DISTINCT array_to_string(l[k : len(l)], '.') AS src, array_to_string(l[k + 1 : len(l)], '.') AS dst
    FROM (SELECT l, unnest(range(1, len(l) - 1)) AS k FROM labels WHERE len(l) > 2)),
edges AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT * FROM links UNION ALL SELECT src, dst, 1.0 FROM parents) GROUP BY src, dst),
moves AS (SELECT 'trust' AS kind, src AS host, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges),
total AS (SELECT kind, host, sum(weight) AS total FROM moves GROUP BY kind, host),
known AS (SELECT DISTINCT host FROM (SELECT src AS host FROM edges UNION SELECT dst FROM edges UNION SELECT host FROM judged WHERE host <> '')),
steps AS (SELECT kind, host, dst, weight / total AS share FROM moves JOIN total USING (kind, host)
    UNION ALL SELECT k.kind, known.host, known.host, 1.0 FROM known, (VALUES ('trust'), ('distrust')) k(kind)
    WHERE NOT EXISTS (SELECT 1 FROM total t WHERE t.kind = k.kind AND t.host = known.host)),
{_rounds_sql()},
scores AS (SELECT host, sum(CASE WHEN kind = 'distrust' THEN score ELSE -score END) AS net FROM r{url_filter.ROUNDS} GROUP BY host)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN coalesce(net, 0) >= {url_filter.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN scores USING (host)
"""


@query("op2_fingerprints")
def op2_fingerprints(spark, sf_dir):
    return fingerprints.edit_report(table(spark, sf_dir, "documents"))


@query("op3_url_filter", OP3_SQL)
def op3_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("trust", "distrust")
