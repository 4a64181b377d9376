"""Ranked search of the documents for every benchmark item."""

from __future__ import annotations

from reportlake.llm import term_pipeline
from reportlake.llm.registry import query, table

_TERMS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])"""

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
c AS (SELECT CAST(count(*) FILTER (WHERE len(t) > 0) AS BIGINT) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d),
p AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS t FROM d) GROUP BY r, t),
f AS (SELECT t, CAST(count(*) AS BIGINT) AS df FROM p GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM f, c),
m AS (SELECT r, doc_id, 10 + (90 * CAST(len(t) AS BIGINT) * nn) // ll AS m FROM d, c WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark),
it AS (SELECT DISTINCT q, item_id, t FROM (SELECT q, item_id, unnest(t) AS t FROM i)),
s AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM it JOIN w USING (t) JOIN p USING (t) JOIN m USING (r) GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""


@query("op13_term_pipeline", OP13_SQL)
def op13_term_pipeline(spark, sf_dir):
    return term_pipeline.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
