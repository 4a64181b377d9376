"""Queries over document texts: decontamination and secret scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from reportlake.llm import decontaminate, language, language_model, secrets
from reportlake.llm.registry import query, table

_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

OP1_SQL = f"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
wi AS (SELECT item, w, least(10, len(w)) AS k, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS j FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[j + 1 : j + k], ' ') AS g FROM wi),
sizes AS (SELECT DISTINCT k FROM win),
dp AS (SELECT rid, w, k, unnest(range(0, len(w) - k + 1)) AS j FROM dw, sizes WHERE len(w) >= k),
dg AS (SELECT rid, k, j, array_to_string(w[j + 1 : j + k], ' ') AS g FROM dp),
occ AS (SELECT rid, j, dg.k, item FROM dg JOIN win ON dg.g = win.g AND dg.k = win.k),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(j, j + k)) AS p FROM occ) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM occ GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (rid) LEFT JOIN its USING (rid)
"""


@query("op1_decontaminate", OP1_SQL)
def op1_decontaminate(spark, sf_dir):
    found = decontaminate.match_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


@query("op10_secrets")
def op10_secrets(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.find_secrets(documents, secrets.train_from_documents(documents)))


@query("op4_language")
def op4_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    model = language.fit(documents.where(fold != 0))
    found = language.predict(documents, model)
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


@query("op8_language_model")
def op8_language_model(spark, sf_dir):
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7))
    return language_model.score(table(spark, sf_dir, "documents"), fold == 2)
