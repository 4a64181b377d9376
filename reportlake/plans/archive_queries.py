"""[lake] zip queries: a report lake repacked as zip archives, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.operators import catalog as C
from reportlake.operators import load as L
from reportlake.plans.fixtures import LANDING_SPEC, report_lake, write_named_gzip, write_named_zips, zip_lake
from reportlake.plans.registry import register
from reportlake.session import shared_dir
from reportlake.sources import archives, csvlake
from reportlake.sources.csvlake import typed_value


def _archive_date(col: str = "archive") -> F.Column:
    return F.to_date(F.regexp_extract(F.col(col), "report_date=([0-9-]+)/", 1))


@register(
    "zip_ingest",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_rows,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price FROM orders GROUP BY 1""",
)
def zip_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV entries of zip archives (any depth, macOS junk skipped) parsed into rows."""
    head = csvlake.lake_head(spark, report_lake(spark, sf_dir, "orders"))
    lines = archives.archive_lines(spark, zip_lake(spark, sf_dir, "orders"))
    rows = archives.archive_rows(lines, head.columns)
    return rows.groupBy(_archive_date().alias("report_date")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(typed_value(F.col("total_price__usd"), "BIGNUMERIC").cast("decimal(18,2)")).cast("double").alias("sum_price"),
    )


@register(
    "zip_audit",
    """SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS report_date, TRUE AS all_ok,
              CAST(1 AS BIGINT) AS csv_per_archive, CAST(1 AS BIGINT) AS skipped_per_archive FROM orders""",
)
def zip_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Central-directory guard per archive: size limit, ratio, CSV entries, skipped metadata."""
    a = archives.audit(archives.archive_entries(spark, zip_lake(spark, sf_dir, "orders")))
    return a.groupBy(_archive_date().alias("report_date")).agg(
        F.bool_and(F.col("status") == "ok").alias("all_ok"),
        F.max("n_csv").alias("csv_per_archive"),
        F.max("n_skipped").alias("skipped_per_archive"),
    )


#: Orders of one bucket of ``zip_load``: an entry holds a bucket's orders of one owner and month.
ZIP_KEYS = 200_000


@register(
    "zip_load",
    f"""WITH d AS (SELECT o_orderkey % 4 AS k, date_trunc('month', o_orderdate) AS m, o_orderkey // {ZIP_KEYS} AS b, o_orderkey, o_totalprice FROM orders),
    f AS (SELECT k, m, b, count(*) AS n, sum(o_orderkey) AS s FROM d GROUP BY k, m, b),
    x AS (SELECT status, reason, files, n_rows, sum_key FROM (
      SELECT 'ok' AS status, NULL AS reason, count(*) AS files, sum(n) AS n_rows, sum(s) AS sum_key FROM f
      UNION ALL SELECT 'rejected', 'bad_zip', 1, 0, 0 UNION ALL SELECT 'rejected', 'no_csv', 1, 0, 0
      UNION ALL SELECT 'rejected', 'date_key_invalid', 1, 0, 0 UNION ALL SELECT 'duplicate', NULL, 1, 0, 0))
    SELECT status, reason, CAST(files AS BIGINT) AS files, CAST(n_rows AS BIGINT) AS n_rows, CAST(sum_key AS BIGINT) AS sum_key FROM x""",
)
def zip_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip archives (one an owner and year, nested entries with quoted line breaks, titles and other
    column orders, macOS junk), plain dated CSV files, a bad archive, one without CSV, an entry with a bad
    date and one that comes twice, all through the load log into one folder (S16, S17, K8)."""
    root, lake_root = shared_dir(spark, "zip-landing"), shared_dir(spark, "zip-loaded")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    note = F.concat(F.lit('"two\nlines, of '), F.col("o_orderkey").cast("string"), F.lit('"'))
    cells = o.select(
        (F.col("o_orderkey") % 4).alias("k"), F.year("o_orderdate").alias("y"), F.date_format("o_orderdate", "yyyyMM").alias("ym"), (F.col("o_orderkey") / ZIP_KEYS).cast("long").alias("b"),
        F.col("o_orderkey").cast("string").alias("key"), note.alias("note"))
    even = F.col("k") % 2 == 0
    line = F.when(even, F.concat_ws(",", "key", "note")).otherwise(F.concat_ws(",", "note", "key"))
    files = cells.groupBy("k", "y", "ym", "b").agg(F.array_join(F.collect_list(line), "\n").alias("text"))  # a bucket bounds them
    name = F.concat(F.lit("ledger__"), "ym", F.lit("__own"), F.col("k").cast("string"), F.lit("__d"), F.col("b").cast("string"), F.lit(".csv"))
    files = files.select("k", "y", "b", name.alias("name"), F.concat(F.when(even, F.lit("Title\nkey,note\n")).otherwise(F.lit("note,key\n")), "text", F.lit("\n")).alias("content"))
    write_named_gzip(files.where("k = 3").select("name", "content"), root)  # plain: the names don't end in .gz
    entry = F.struct(F.concat(F.lit("exports/nested/"), "name").alias("entry"), "content")
    junk = F.array(F.struct(F.lit("__MACOSX/exports/._x.csv").alias("entry"), F.lit("junk").alias("content")))
    packed = files.where("k < 3").groupBy("k", "y", "b").agg(F.concat(F.collect_list(entry), junk).alias("entries"))  # a year's entries of a bucket
    packed = packed.select(F.concat(F.lit("pack "), F.col("k").cast("string"), F.lit("_"), F.col("y").cast("string"), F.lit("_"), F.col("b").cast("string"), F.lit(".zip")).alias("name"), "entries")
    odd = spark.createDataFrame([("odd.zip", [("ledger__199513__bad__d1.csv", "key,note\n1,x\n")]), ("nothing.zip", [("readme.txt", "x")])], "name string, entries array<struct<entry string, content string>>")
    write_named_zips(packed.unionByName(odd), root)
    write_named_gzip(spark.createDataFrame([("bad.zip", "not an archive")], "name string, content string"), root)
    twice = files.where("k = 3").agg(F.min(F.struct("name", "content")).alias("f"))
    write_named_gzip(twice.select(F.concat(F.lit("zz/"), "f.name").alias("name"), "f.content"), root)
    L.upload_archives(spark, root, [LANDING_SPEC], lake_root)
    L.upload(spark, C.build_catalog(C.list_files(spark, root, "*.csv"), [LANDING_SPEC]), lake_root, recompress=True)
    log = L.read_log(spark, lake_root)
    folder = LANDING_SPEC.storage_folder_name
    landed = L.committed(spark, L.read_landed(spark, f"{lake_root}/{folder}"), lake_root)
    whole = F.col("note") == F.concat(F.lit("two\nlines, of "), F.col("key"))
    rows = landed.where(whole).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("key").cast("bigint")).alias("s"))
    found = log.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("files"))
    ok = F.col("status") == "ok"
    return found.crossJoin(rows).select(  # one row of sums beside one row a status
        "status", "reason", "files", F.when(ok, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("n_rows"), F.when(ok, F.col("s")).otherwise(F.lit(0)).cast("bigint").alias("sum_key"))
