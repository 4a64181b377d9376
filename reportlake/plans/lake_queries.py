"""[lake] queries: driver tables written as gzip CSV report lakes, read back by the engine.

Oracles run on the original parquet tables, so a match checks the whole path:
layout detection, header removal per file, name normalisation, the vote,
typed conversion and partition discovery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.operators import infer
from reportlake.plans.fixtures import lake_values_sql, report_lake, write_named_gzip
from reportlake.plans.registry import register
from reportlake.session import shared_dir
from reportlake.sources import csvlake

#: Orders of one bucket of ``lake_scan_drift``: a file holds a bucket's orders of one month.
DRIFT_KEYS = 50_000


def orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.read_typed(spark, report_lake(spark, sf_dir, "orders"), scope="all_rows")


@register(
    "rows_per_report_date",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_rows
       FROM orders GROUP BY 1 ORDER BY 1 DESC""",
)
def rows_per_report_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per report date, newest first, over the typed lake (A9, the documented user query)."""
    lake = infer.read_typed(spark, report_lake(spark, sf_dir, "orders"))
    return (
        lake
        .groupBy("report_date")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("report_date"))
    )


def _lake(spark: SparkSession, sf_dir: str, table: str) -> str:
    return report_lake(spark, sf_dir, table)


def _duck_norm(header: str) -> str:
    """A header cell normalised in Python text for the oracle (same rule, written out)."""
    out = header
    for ch in " .-/(":
        out = out.replace(ch, "_")
    for ch in ")?:":
        out = out.replace(ch, "")
    return out.lower()


def _lake_long_sql(table: str) -> str:
    from reportlake.plans.fixtures import lake_columns

    _, cols = lake_columns(table)
    return " UNION ALL ".join(
        f"SELECT '{_duck_norm(c.header)}' AS column_name, {i} AS position, \"{c.header}\" AS v, report_date FROM lake_{table}"
        for i, c in enumerate(cols)
    )


@register(
    "file_listing",
    """SELECT DISTINCT 'report_date=' || strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS folder,
              TRUE AS all_gz, TRUE AS all_non_empty FROM orders""",
)
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive listing of a lake (content never read), summarised per partition folder."""
    from reportlake.operators.catalog import list_files

    files = list_files(spark, _lake(spark, sf_dir, "orders"))
    folder = F.element_at(F.split("path", "/"), -2)
    return files.groupBy(folder.alias("folder")).agg(
        F.bool_and(F.col("path").endswith(".csv.gz")).alias("all_gz"),
        F.bool_and(F.col("length") > 0).alias("all_non_empty"),
    )


@register(
    "lake_scan",
    """SELECT last_day(CAST(l_shipdate AS DATE)) AS report_date, count(*) AS n_rows,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, count(DISTINCT l_orderkey) AS n_orders
       FROM lineitem GROUP BY 1""",
)
def lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip CSV scan of a partitioned lake with an explicit all-text schema."""
    root = _lake(spark, sf_dir, "lineitem")
    head = csvlake.lake_head(spark, root)
    raw = csvlake.read_raw(spark, root, head, with_source=False)
    return raw.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("quantity").cast("decimal(18,2)")).cast("double").alias("sum_qty"),
        F.count_distinct("order_key").alias("n_orders"),
    )


@register(
    "lake_scan_mixed_layout",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_rows, CAST(0 AS BIGINT) AS header_rows,
              CAST(0 AS BIGINT) AS title_rows FROM orders GROUP BY 1""",
)
def lake_scan_mixed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titled and untitled files in one scan: no title or header row leaks into the data."""
    root = _lake(spark, sf_dir, "orders")
    head = csvlake.lake_head(spark, root)
    raw = csvlake.read_raw(spark, root, head, with_source=False)
    return raw.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("order_key") == head.header[0]).alias("header_rows"),
        F.count_if(F.col("order_key") == "Monthly report").alias("title_rows"),
    )


_DRIFT = {0: ("key,price,note\n", ("key", "price", "note")), 1: ("Monthly report\nprice,note,key\n", ("price", "note", "key")), 2: ("note,key,price,Extra (New)\n", ("note", "key", "price", "extra"))}


def _drifted_lake(spark: SparkSession, sf_dir: str) -> str:
    """Orders as files by (month, bucket of keys), with three headers by month (another order and a
    title; another order and one more column) and in every file a data row equal to its header."""
    root = shared_dir(spark, "lake-drifted")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cells = o.select(
        F.last_day(F.to_date("o_orderdate")).alias("d"), (F.col("o_orderkey") / DRIFT_KEYS).cast("long").alias("b"), F.col("o_orderkey").cast("string").alias("key"),
        F.format_string("%.2f", "o_totalprice").alias("price"), F.concat(F.lit('"a, ""b""\n'), F.col("o_orderkey").cast("string"), F.lit('"')).alias("note"), F.lit("e").alias("extra"))
    for kind, (head, columns) in _DRIFT.items():
        files = cells.where(F.month("d") % 3 == kind).groupBy("d", "b").agg(F.array_join(F.collect_list(F.concat_ws(",", *columns)), "\n").alias("text"))  # a bucket bounds them
        name = F.concat(F.lit("report_date="), F.date_format("d", "yyyy-MM-dd"), F.lit("/part_"), F.col("b").cast("string"), F.lit(".csv.gz"))
        header = head.split("\n")[-2]
        write_named_gzip(files.select(name.alias("name"), F.concat(F.lit(head), "text", F.lit(f"\n{header}\n")).alias("content")), root)
    return root


@register(
    "lake_scan_drift",
    f"""WITH r AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, o_orderkey, o_totalprice, o_orderkey // {DRIFT_KEYS} AS b FROM orders)
    SELECT report_date, count(*) + count(DISTINCT b) AS n_rows, count(DISTINCT b) AS header_rows, count(*) AS n_notes, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
           sum(o_orderkey) AS sum_key, CASE WHEN month(report_date) % 3 = 2 THEN count(*) ELSE 0 END AS n_extra FROM r GROUP BY report_date""",
)
def lake_scan_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake whose files differ in the order and number of columns, in one scan: cells by the names of
    their own header, the header under a title dropped by its place, data rows equal to it kept (S11, S12)."""
    root = _drifted_lake(spark, sf_dir)
    head = csvlake.lake_head(spark, root)
    raw = csvlake.read_raw(spark, root, head, with_source=False)
    note = F.col("note") == F.concat(F.lit('a, "b"\n'), F.col("key"))
    return raw.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if((F.col("key") == "key") & (F.col("price") == "price")).alias("header_rows"), F.count_if(note).alias("n_notes"),
        F.sum(F.col("price").try_cast("decimal(18,2)")).cast("double").alias("sum_price"), F.sum(F.col("key").try_cast("bigint")).alias("sum_key"), F.count_if(F.col("extra__new") == "e").alias("n_extra"))


@register(
    "file_layouts",
    """SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS report_date,
              month(CAST(o_orderdate AS DATE)) % 2 = 0 AS titled, CAST(1 AS BIGINT) AS header_variants,
              CAST(CASE WHEN month(CAST(o_orderdate AS DATE)) % 2 = 0 THEN 1 ELSE 8 END AS BIGINT) AS first_fields
       FROM orders""",
)
def file_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title row detection per file, summarised per partition."""
    root = _lake(spark, sf_dir, "orders")
    heads = csvlake.file_heads(spark, root)
    rd = F.to_date(F.regexp_extract("file_path", "report_date=([0-9-]+)/", 1))
    return heads.groupBy(rd.alias("report_date")).agg(
        F.bool_and("has_title").alias("titled"),
        F.count_distinct("header").alias("header_variants"),
        F.max(F.when(F.col("has_title"), 1).otherwise(F.size("header"))).cast("bigint").alias("first_fields"),
    )


@register(
    "file_headers",
    """SELECT 'Order Key,Cust Key,Order Status,Total Price (USD),Order Date,Order Priority,Is Urgent?,Comment' AS header_line,
              'order_key,cust_key,order_status,total_price__usd,order_date,order_priority,is_urgent,comment' AS columns,
              count(DISTINCT last_day(CAST(o_orderdate AS DATE))) AS n_folders FROM orders""",
)
def file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header row of every file (below a title when present) and its normalised names."""
    heads = csvlake.file_heads(spark, _lake(spark, sf_dir, "orders"))
    folder = F.regexp_extract("file_path", "(report_date=[0-9-]+)/", 1)
    found = heads.groupBy("header", "columns").agg(F.count_distinct(folder).alias("n_folders"))
    return found.select(F.array_join("header", ",").alias("header_line"), F.array_join("columns", ",").alias("columns"), "n_folders")


@register(
    "sample_rows",
    """SELECT max(last_day(CAST(o_orderdate AS DATE))) AS newest_date, TRUE AS one_month, TRUE AS within_limit,
              CAST(0 AS BIGINT) AS header_rows FROM orders""",
)
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 data rows of the newest file, title and header skipped: what holds of them in any
    row order (S13, L5)."""
    root = _lake(spark, sf_dir, "orders")
    head = csvlake.lake_head(spark, root)
    sample = csvlake.read_raw(spark, head.newest_path, head, with_source=False).limit(100)
    month = F.last_day(F.to_date("order_date"))
    return sample.agg(
        F.max(month).alias("newest_date"), (F.min(month) == F.max(month)).alias("one_month"),
        F.count(F.lit(1)).between(1, 100).alias("within_limit"), F.count_if(F.col("order_key") == head.header[0]).alias("header_rows"),
    )


@register(
    "partition_filter",
    """SELECT o_orderkey AS order_key, CAST(o_totalprice AS DOUBLE) AS total_price__usd,
              CAST(o_orderdate AS DATE) AS order_date, last_day(CAST(o_orderdate AS DATE)) AS report_date
       FROM orders WHERE last_day(CAST(o_orderdate AS DATE)) = DATE '1996-06-30'
       ORDER BY o_orderkey LIMIT 10""",
)
def partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documented user query: one report date, first rows by key; only that folder is read."""
    df = orders_typed(spark, sf_dir)
    return (
        df.where(F.col("report_date") == F.lit("1996-06-30").cast("date"))
        .select("order_key", F.col("total_price__usd").cast("double").alias("total_price__usd"), "order_date",
                "report_date")
        .orderBy("order_key")
        .limit(10)
    )


@register(
    "table_state",
    """SELECT 'orders' AS table_name, count(*) AS n_rows,
              count(DISTINCT last_day(CAST(o_orderdate AS DATE))) AS n_partitions, TRUE AS has_files FROM orders""",
)
def table_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, partition values and files per table (A10)."""
    df = orders_typed(spark, sf_dir)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("report_date").alias("n_partitions"),
        (F.count_distinct("src_file") > 0).alias("has_files"),
    ).select(F.lit("orders").alias("table_name"), "*")


def _vote_oracle(table: str, extra_select: str = "") -> str:
    from reportlake.plans.value_queries import VOTE_SQL, _class_sql

    return (
        f"WITH {lake_values_sql(table)}, l AS ({_lake_long_sql(table)}), "
        f"p AS (SELECT column_name, position, {_class_sql('v')} AS k FROM l), "
        "prof AS (SELECT column_name, CAST(position AS BIGINT) AS position, count(k) AS n_non_null, "
        "count(*) FILTER (WHERE k = 'INT64') AS n_int64, count(*) FILTER (WHERE k = 'BOOL') AS n_bool, "
        "count(*) FILTER (WHERE k = 'BIGNUMERIC') AS n_bignumeric, count(*) FILTER (WHERE k = 'TIMESTAMP') AS n_timestamp, "
        "count(*) FILTER (WHERE k = 'DATE') AS n_date FROM p GROUP BY 1, 2) "
        f"SELECT position, column_name, n_non_null, {VOTE_SQL} AS inferred_type{extra_select} FROM prof"
    )


def _lake_schema_rows(spark: SparkSession, root: str, with_title: bool) -> DataFrame:
    head = csvlake.lake_head(spark, root)
    raw = csvlake.read_raw(spark, root, head, with_source=False)
    out = infer.decide(infer.profile(raw, head.columns)).select("position", "column_name", "n_non_null", "inferred_type")
    if with_title:
        out = out.withColumn("has_title", F.lit(head.has_title))
    return out


@register(
    "infer_lake_schema",
    _vote_oracle(
        "orders",
        ", (SELECT month(max(CAST(o_orderdate AS DATE))) % 2 = 0 FROM orders) AS has_title",
    ),
)
def infer_lake_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder to typed schema by a vote over all rows, plus the newest file's title flag."""
    return _lake_schema_rows(spark, _lake(spark, sf_dir, "orders"), with_title=True)


@register("infer_types_revenue", _vote_oracle("lineitem"))
def infer_types_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed int/decimal column: BIGNUMERIC when its name says revenue, STRING otherwise (I4)."""
    return _lake_schema_rows(spark, _lake(spark, sf_dir, "lineitem"), with_title=False)


@register("infer_ragged", _vote_oracle("events"))
def infer_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short rows: a missing last cell is NULL and does not count against the vote."""
    return _lake_schema_rows(spark, _lake(spark, sf_dir, "events"), with_title=False)


@register(
    "lake_scan_typed",
    """SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status,
              CAST(o_totalprice AS DOUBLE) AS total_price__usd, CAST(o_orderdate AS DATE) AS order_date,
              o_orderpriority AS order_priority, o_orderpriority = '1-URGENT' AS is_urgent,
              CASE WHEN o_orderkey % 4 = 3 THEN 'c' || CAST(o_custkey AS VARCHAR) END AS comment,
              last_day(CAST(o_orderdate AS DATE)) AS report_date
       FROM orders""",
)
def lake_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text scan with the inferred types applied; null tokens become NULL."""
    root = _lake(spark, sf_dir, "orders")
    schema = infer.infer_lake_schema(spark, root, scope="all_rows")
    raw = csvlake.read_raw(spark, root, schema.head, with_source=False)
    typed = csvlake.apply_types(raw, schema.columns, schema.types, strings_null_tokens=True)
    return typed.withColumn("total_price__usd", F.col("total_price__usd").cast("double"))


@register(
    "null_tokens",
    f"""WITH {lake_values_sql('orders')}, l AS ({_lake_long_sql('orders')})
    SELECT column_name, count(*) AS n_cells,
           count(*) FILTER (WHERE v IS NULL OR lower(regexp_replace(v, '^\\s+|\\s+$', '', 'g')) IN ('', 'null', 'none'))
             AS n_null_tokens
    FROM l GROUP BY 1""",
)
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per column that are '', 'null' or 'none' after trimming."""
    from reportlake.functions import values as V

    root = _lake(spark, sf_dir, "orders")
    head = csvlake.lake_head(spark, root)
    raw = csvlake.read_raw(spark, root, head, with_source=False)
    aggs = []
    for c in head.columns:
        aggs += [F.count(F.lit(1)).alias(f"{c}__n"), F.count_if(V.null_if_token(F.col(c)).isNull()).alias(f"{c}__t")]
    wide = raw.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("n_cells"), F.col(f"{c}__t").alias("n_null_tokens"))
        for c in head.columns
    ])))


_PLAIN: dict = {}


@register(
    "infer_fallback",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_rows,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price FROM orders GROUP BY 1""",
)
def infer_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No ``.csv.gz`` to sample: fall back to Spark's own CSV inference over the folder."""
    from reportlake.session import shared_dir

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PLAIN:
        root = shared_dir(spark, "plain-orders")
        (
            spark.read.parquet(f"{sf_dir}/orders.parquet")
            .withColumn("report_date", F.last_day(F.to_date("o_orderdate")))
            .write.partitionBy("report_date").option("header", "true").csv(root)
        )
        _PLAIN[key] = root
    df = infer.read_typed(spark, _PLAIN[key], autodetect_fallback=True)
    return df.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sum_price")
    )
