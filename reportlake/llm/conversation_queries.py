"""Queries over conversations: the trie of their prefixes after a rebuild with shared heads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm import prefix_trie
from reportlake.llm.registry import query, table

GROUP, HEADS = 100, 6

OP12_SQL = f"""
WITH RECURSIVE own AS (
  SELECT conv_id AS c, list(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '') ORDER BY turn NULLS FIRST) AS k,
         list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM own
  UNION ALL
  SELECT c, s, i + 1, xor(b >> 1, 3988292384 * (b & 1))
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END AS b FROM crc) WHERE i < 8 * length(s)),
heads AS (SELECT c, CAST(xor(v, 4294967295) % {HEADS} AS BIGINT) AS h FROM crc WHERE i = 8 * length(s)),
built AS (
  SELECT o.c, list_concat(coalesce(b.k[1:h], []), o.k[h + 1:]) AS k, list_concat(coalesce(b.n[1:h], []), o.n[h + 1:]) AS n
  FROM own o JOIN heads USING (c) LEFT JOIN own b ON b.c = o.c - o.c % {GROUP}),
steps AS (SELECT c, k, n, unnest(range(0, len(k) + 1)) AS d FROM built),
nodes AS (
  SELECT k[1:d] AS p, d, min(c) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE any_value(n[d]) END AS chars,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(k) = d), '') AS ends
  FROM steps GROUP BY k[1:d], d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY p[1:d - 1]),
above AS (SELECT n.p, unnest(range(0, n.d + 1)) AS j, (n_convs - 1) * chars AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes n LEFT JOIN kids USING (p)),
sums AS (SELECT p[1:j] AS p, sum(saved) AS saved, sum(leaf) AS leaves FROM above GROUP BY p[1:j])
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN kids USING (p) JOIN sums USING (p) LEFT JOIN nodes u ON n.d > 0 AND u.p = n.p[1:n.d - 1]
"""


def rebuilt(sequences: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % group in the place of its own
    first h; h = crc32(c) % heads. Only the heads of the conversations that others take up are joined."""
    c = F.col("conv_id")
    first = sequences.where(c % group == 0).select(c.alias("lead"), F.slice("turns", 1, heads - 1).alias("lead_turns"))
    h = F.pmod(F.crc32(c.cast("string")), F.lit(heads)).cast("int")
    joined = sequences.withColumn("lead", c - c % group).join(first, "lead", "left").withColumn("h", h)
    head = F.coalesce(F.slice("lead_turns", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


@query("op12_prefix_trie", OP12_SQL)
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(rebuilt(prefix_trie.sequences(table(spark, sf_dir, "conversations")))).drop("turn_key")
