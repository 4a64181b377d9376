"""Scalar-function and inference queries over driver tables (no files involved).

Covers date keys, month ends, readable sizes, path parts, path/object-name
audits, header normalisation, per-value classes, column profiles and the vote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions import names as N
from reportlake.functions import paths as P
from reportlake.functions import values as V
from reportlake.operators import infer
from reportlake.plans.catalog_queries import SIZE_SQL
from reportlake.plans.registry import register
from reportlake.session import spread


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


# ---------------------------------------------------------------- P4, P5, P6

DATE_KEY_SQL = """CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d')
                                  WHEN 1 THEN strftime(o_orderdate, '%Y%m')
                                  WHEN 2 THEN strftime(o_orderdate, '%Y%m') || '31'
                                  ELSE CAST(o_custkey AS VARCHAR) END"""


@register(
    "date_keys",
    f"""WITH k AS (SELECT o_orderkey, {DATE_KEY_SQL} AS date_key FROM orders),
    p AS (SELECT *, TRY_CAST(substr(date_key, 1, 4) AS INTEGER) AS y, TRY_CAST(substr(date_key, 5, 2) AS INTEGER) AS m,
                 CASE WHEN length(date_key) = 8 THEN TRY_CAST(substr(date_key, 7, 2) AS INTEGER) ELSE 1 END AS d FROM k),
    v AS (SELECT *, CASE WHEN length(date_key) IN (6, 8) AND regexp_matches(date_key, '^[0-9]+$')
                          AND y BETWEEN 1900 AND 2100 AND m BETWEEN 1 AND 12
                          AND d BETWEEN 1 AND day(last_day(make_date(y, m, 1))) THEN make_date(y, m, d) END AS key_date
          FROM p)
    SELECT o_orderkey, date_key, key_date,
           CASE WHEN length(date_key) NOT IN (6, 8) THEN 'date_key_length'
                WHEN key_date IS NULL THEN 'date_key_invalid' END AS error
    FROM v""",
)
def date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """YYYYMMDD / YYYYMM keys to dates with reasons for the bad ones."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    key = (
        F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(k % 4 == 1, F.date_format("o_orderdate", "yyyyMM"))
        .when(k % 4 == 2, F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("31")))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return o.select("o_orderkey", key.alias("date_key")).select(
        "o_orderkey", "date_key", N.date_key_to_date("date_key").alias("key_date"),
        N.date_key_error("date_key").alias("error"),
    )


@register(
    "month_end",
    """SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS report_date,
              strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS report_date_str,
              CAST(strftime(last_day(CAST(o_orderdate AS DATE)), '%Y%m%d') AS BIGINT) AS report_date_key
       FROM orders""",
)
def month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-end date, its text and its integer key (P5)."""
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey",
        N.month_end("o_orderdate").alias("report_date"),
        N.month_end_str("o_orderdate").alias("report_date_str"),
        N.month_end_key("o_orderdate").alias("report_date_key"),
    )


@register(
    "readable_size",
    "WITH s AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * CAST(pow(1024, o_orderkey % 5) AS BIGINT)"
    " AS size_bytes FROM orders) SELECT o_orderkey, size_bytes, " + SIZE_SQL.format(n="size_bytes")
    + " AS file_size FROM s",
)
def readable_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes to "2.50 MB" text over B..PB, ties to even."""
    o = _t(spark, sf_dir, "orders")
    size = F.floor("o_totalprice").cast("bigint") * F.pow(F.lit(1024), F.col("o_orderkey") % 5).cast("bigint")
    return o.select("o_orderkey", size.alias("size_bytes")).select(
        "o_orderkey", "size_bytes", N.readable_size("size_bytes").alias("file_size")
    )


# ---------------------------------------------------------------- P8, S5, P23

OBJECT_NAME_SQL = """CASE WHEN page_id % 5 = 0 THEN '../' WHEN page_id % 7 = 0 THEN '%2e%2e/'
                         WHEN page_id % 11 = 0 THEN '/' WHEN page_id % 13 = 0 THEN 'a/./b/../'
                         WHEN page_id % 17 = 0 THEN '%2e%2e/%zz/' WHEN page_id % 19 = 0 THEN '%2525252525252e./'
                         WHEN page_id % 23 = 0 THEN '%2525252541+%c3%bc%/' WHEN page_id % 29 = 0 THEN 'a%252500b' ELSE '' END
                    || regexp_replace(url, '^[a-z]+://[^/]+/?', '')"""


def _object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = F.col("page_id")
    prefix = (
        F.when(pid % 5 == 0, F.lit("../")).when(pid % 7 == 0, F.lit("%2e%2e/"))
        .when(pid % 11 == 0, F.lit("/")).when(pid % 13 == 0, F.lit("a/./b/../"))
        .when(pid % 17 == 0, F.lit("%2e%2e/%zz/")).when(pid % 19 == 0, F.lit("%2525252525252e./"))
        .when(pid % 23 == 0, F.lit("%2525252541+%c3%bc%/")).when(pid % 29 == 0, F.lit("a%252500b")).otherwise(F.lit(""))
    )
    return _t(spark, sf_dir, "pages").select(
        "page_id", F.concat(prefix, F.regexp_replace("url", "^[a-z]+://[^/]+/?", "")).alias("object_name")
    )


@register(
    "path_parts",
    """SELECT page_id, regexp_extract(url, '[^/]*$') AS base_name,
              CASE WHEN contains(url, '/') THEN regexp_replace(url, '/[^/]*$', '') ELSE '' END AS parent_dir,
              CAST(length(url) AS BIGINT) AS n_chars
       FROM pages""",
)
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base name, parent and length of a path."""
    return _t(spark, sf_dir, "pages").select(
        "page_id", N.base_name("url").alias("base_name"), N.parent_dir("url").alias("parent_dir"),
        F.length("url").cast("bigint").alias("n_chars"),
    )


_NORM_SQL = """list_reduce(string_split('site/' || object_name, '/'),
      lambda acc, seg: CASE WHEN seg = '.' OR (seg = '' AND len(acc) > 0) THEN acc
                            WHEN seg = '..' AND len(acc) > 0 AND acc[len(acc)] <> '..' AND acc[len(acc)] <> ''
                                 THEN acc[1:len(acc) - 1]
                            ELSE list_append(acc, seg) END, []::VARCHAR[])"""


@register(
    "path_audit",
    f"""WITH RECURSIVE n AS (SELECT page_id, {OBJECT_NAME_SQL} AS object_name FROM pages),
    forms AS (SELECT page_id, object_name AS f FROM n
              UNION ALL SELECT page_id, url_decode(f) FROM forms WHERE url_decode(f) <> f),
    worst AS (SELECT page_id, max(length(f)) > 1024 AS too_long, bool_or(contains(f, '..') OR starts_with(f, '/')) AS up,
                     bool_or(regexp_matches(f, '[\\x00-\\x1f]')) AS control FROM forms GROUP BY page_id)
    SELECT page_id, object_name,
           array_to_string({_NORM_SQL}, '/') = 'site' OR starts_with(array_to_string({_NORM_SQL}, '/'), 'site/') AS within_root,
           array_to_string(list_filter([CASE WHEN too_long THEN 'too_long' END, CASE WHEN up THEN 'path_traversal' END,
             CASE WHEN control THEN 'control_chars' END], lambda x: x IS NOT NULL), ',') AS violations
    FROM n JOIN worst USING (page_id)""",
)
def path_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object names derived from page URLs: inside the root after folding ``.``/``..``, and the
    name-rule violations incl. URL-encoded traversal (S5, P23)."""
    names = _object_names(spark, sf_dir)
    return names.select(
        "page_id", "object_name",
        P.is_within(F.concat(F.lit("site/"), F.col("object_name")), "site").alias("within_root"),
        F.array_join(P.object_name_violations("object_name"), ",").alias("violations"),
    )


# ---------------------------------------------------------------- P13


def _header_array(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey",
        F.array(
            F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.col("p_type"),
            F.concat(F.upper("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")")), F.lit("Size?"),
            F.concat(F.lit("Ratio: "), F.col("p_type"), F.lit("/Size-"), F.col("p_size").cast("string")),
        ).alias("header"),
    )


_DUCK_NORM_CELL = "lower(replace(replace(replace(replace(replace(replace(replace(replace(x, ' ', '_'), '.', '_'), '-', '_'), '/', '_'), '(', '_'), ')', ''), '?', ''), ':', ''))"


@register(
    "normalize_columns",
    f"""WITH h AS (SELECT p_partkey, [p_brand, p_type, p_name, p_type, upper(p_name) || ' (' || p_type || ')', 'Size?',
                                     'Ratio: ' || p_type || '/Size-' || CAST(p_size AS VARCHAR)] AS header FROM part),
    n AS (SELECT p_partkey, list_transform(header, lambda x: {_DUCK_NORM_CELL}) AS names FROM h)
    SELECT p_partkey, array_to_string(list_reduce(names, lambda acc, x: list_append(acc,
        CASE WHEN list_contains(acc, x)
             THEN x || '_' || CAST(list_min(list_filter(range(1, len(acc) + 2),
                                   lambda s: NOT list_contains(acc, x || '_' || CAST(s AS VARCHAR)))) AS VARCHAR)
             ELSE x END), []::VARCHAR[]), ',') AS columns
    FROM n""",
)
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header cells from part rows to warehouse names; repeats get the smallest free suffix."""
    h = _header_array(_t(spark, sf_dir, "part"))
    return h.select("p_partkey", F.array_join(V.normalize_names("header"), ",").alias("columns"))


# ---------------------------------------------------------------- I1, I2, I3, I7


def _class_sql(v: str) -> str:
    """DuckDB classification of one cleaned value (NULL for null tokens)."""
    t = f"regexp_replace({v}, '^\\s+|\\s+$', '', 'g')"
    return f"""CASE WHEN {t} IS NULL OR lower({t}) IN ('', 'null', 'none') THEN NULL
        WHEN regexp_matches({t}, '^[+-]?[0-9]+$') AND NOT regexp_matches({t}, '^0[0-9]') AND TRY_CAST({t} AS BIGINT) IS NOT NULL THEN 'INT64'
        WHEN lower({t}) IN ('true', 'false', 'yes', 'no', '1', '0') THEN 'BOOL'
        WHEN regexp_matches({t}, '^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$') THEN 'BIGNUMERIC'
        WHEN regexp_matches({t}, '^[0-9]{{4}}(-[0-9]{{2}}-|/[0-9]{{2}}/)[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]+)?$') THEN 'TIMESTAMP'
        WHEN regexp_matches({t}, '^[0-9]{{4}}(-[0-9]{{2}}-|/[0-9]{{2}}/)[0-9]{{2}}$') THEN 'DATE'
        ELSE 'STRING' END"""


def _duck_long(table: str, cols: list[str], casts: dict[str, str] | None = None) -> str:
    casts = casts or {}
    parts = [
        f"SELECT '{c}' AS column_name, {i} AS position, {casts.get(c, f'CAST({c} AS VARCHAR)')} AS v FROM {table}"
        for i, c in enumerate(cols)
    ]
    return " UNION ALL ".join(parts)


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _as_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])


@register(
    "classify_values",
    f"""WITH l AS ({_duck_long('events', EVENT_COLS)}),
    c AS (SELECT column_name, {_class_sql('v')} AS value_class FROM l)
    SELECT column_name, value_class, count(*) AS n_values FROM c WHERE value_class IS NOT NULL GROUP BY 1, 2""",
)
def classify_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every cell of ``events`` read as text, counted per column and class."""
    ev = _as_strings(_t(spark, sf_dir, "events"), EVENT_COLS)
    cls = infer.classify(ev, EVENT_COLS)
    long = cls.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__class").alias("value_class")) for c in EVENT_COLS
    ])))
    return long.where(F.col("value_class").isNotNull()).groupBy("column_name", "value_class").agg(
        F.count(F.lit(1)).alias("n_values")
    )


def _duck_profile(long_sql: str) -> str:
    return f"""p AS (SELECT column_name, position, {_class_sql('v')} AS k FROM ({long_sql})),
    prof AS (SELECT column_name, CAST(position AS BIGINT) AS position, count(k) AS n_non_null,
                  count(*) FILTER (WHERE k = 'INT64') AS n_int64, count(*) FILTER (WHERE k = 'BOOL') AS n_bool,
                  count(*) FILTER (WHERE k = 'BIGNUMERIC') AS n_bignumeric,
                  count(*) FILTER (WHERE k = 'TIMESTAMP') AS n_timestamp, count(*) FILTER (WHERE k = 'DATE') AS n_date
           FROM p GROUP BY 1, 2)"""


VOTE_SQL = """CASE WHEN n_non_null < 10 THEN 'STRING'
     WHEN contains(lower(column_name), 'revenue') AND (n_int64 + n_bignumeric) / n_non_null >= 0.95 THEN 'BIGNUMERIC'
     WHEN n_int64 / n_non_null >= 0.95 THEN 'INT64'
     WHEN n_bool / n_non_null >= 0.95 THEN 'BOOL'
     WHEN n_bignumeric / n_non_null >= 0.95 THEN 'BIGNUMERIC'
     WHEN n_timestamp / n_non_null >= 0.95 THEN 'TIMESTAMP'
     WHEN n_date / n_non_null >= 0.95 THEN 'DATE'
     ELSE 'STRING' END"""


@register(
    "column_profile",
    f"WITH {_duck_profile(_duck_long('lineitem', LINEITEM_COLS))} SELECT * FROM prof",
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-null and per-class counts of every ``lineitem`` column read as text, one pass."""
    li = _as_strings(_t(spark, sf_dir, "lineitem"), LINEITEM_COLS)
    return infer.profile(li, LINEITEM_COLS)


@register(
    "infer_types",
    "WITH "
    + ", ".join(
        f"{_duck_profile(_duck_long(t, cols)).replace('p AS', f'p_{t} AS', 1).replace('prof AS', f'prof_{t} AS', 1).replace('FROM p GROUP', f'FROM p_{t} GROUP')}"
        for t, cols in [("events", EVENT_COLS), ("lineitem", LINEITEM_COLS), ("orders", ORDERS_COLS)]
    )
    + " "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, {VOTE_SQL} AS inferred_type FROM prof_{t}"
        for t in ["events", "lineitem", "orders"]
    ),
)
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vote per column of events, lineitem and orders read as text."""
    out = None
    for t, cols in [("events", EVENT_COLS), ("lineitem", LINEITEM_COLS), ("orders", ORDERS_COLS)]:
        d = infer.decide(infer.profile(_as_strings(_t(spark, sf_dir, t), cols), cols))
        d = d.select(F.lit(t).alias("table_name"), "column_name", "inferred_type")
        out = d if out is None else out.unionByName(d)
    return out


@register(
    "type_distribution",
    "WITH "
    + ", ".join(
        f"{_duck_profile(_duck_long(t, cols)).replace('p AS', f'p_{t} AS', 1).replace('prof AS', f'prof_{t} AS', 1).replace('FROM p GROUP', f'FROM p_{t} GROUP')}"
        for t, cols in [("events", EVENT_COLS), ("lineitem", LINEITEM_COLS), ("orders", ORDERS_COLS)]
    )
    + ", v AS ("
    + " UNION ALL ".join(f"SELECT {VOTE_SQL} AS inferred_type FROM prof_{t}" for t in ["events", "lineitem", "orders"])
    + ") SELECT inferred_type, count(*) AS n_columns FROM v GROUP BY 1",
)
def type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns per inferred type over the three tables."""
    parts = None
    for t, cols in [("events", EVENT_COLS), ("lineitem", LINEITEM_COLS), ("orders", ORDERS_COLS)]:
        d = infer.decide(infer.profile(_as_strings(_t(spark, sf_dir, t), cols), cols))
        parts = d if parts is None else parts.unionByName(d)
    return infer.type_distribution(parts)
