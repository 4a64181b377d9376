"""Queries over near-duplicate documents and repeated passages."""

from __future__ import annotations

from reportlake.llm import near_duplicates, passages
from reportlake.llm.registry import query, table

OP6_SQL = r"""
WITH RECURSIVE dw AS (SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
pos AS (SELECT rid, w, unnest(range(0, greatest(len(w) - 4, 1))) AS j FROM dw WHERE len(w) > 0),
sh AS (SELECT DISTINCT rid, array_to_string(w[j + 1 : j + 5], ' ') AS g FROM pos),
size AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
pair AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.rid < y.rid GROUP BY x.rid, y.rid),
link AS (SELECT a, b FROM pair JOIN size p ON p.rid = a JOIN size q ON q.rid = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(rid, other) AS (SELECT rid, rid FROM dw UNION SELECT reach.rid, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
comp AS (SELECT reach.rid, min(dw.doc_id) AS component_id FROM reach JOIN dw ON dw.rid = reach.other GROUP BY reach.rid)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM dw JOIN comp USING (rid) LEFT JOIN size USING (rid)
"""


@query("op6_near_duplicates", OP6_SQL)
def op6_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_passages")
def op7_passages(spark, sf_dir):
    return passages.by_document(passages.repeated_passages(table(spark, sf_dir, "documents")))
