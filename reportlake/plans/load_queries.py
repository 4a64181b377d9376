"""[lake] load queries: land a report lake into a new lake and read it back.

Each query uses fresh folders under the shared checkpoint root, so reruns are
independent. Oracles are counts and sums on the original parquet tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions import names as N
from reportlake.operators import infer
from reportlake.operators import load as L
from reportlake.operators import catalog as C
from reportlake.plans.fixtures import FIXTURE_SPECS, LANDING_SPEC, landing_files, report_lake, write_named_gzip
from reportlake.plans.registry import register
from reportlake.session import shared_dir, spread
from reportlake.sources import csvlake
from reportlake.streaming import ingest

PER_MONTH_SQL = """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_rows,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price FROM orders GROUP BY 1"""


def _landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = report_lake(spark, sf_dir, "orders")
    head = csvlake.lake_head(spark, root)
    return csvlake.read_raw(spark, root, head)


def _per_month(df: DataFrame) -> DataFrame:
    return df.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("total_price__usd").cast("decimal(18,2)")).cast("double").alias("sum_price"),
    )


def _read_back(spark: SparkSession, lake_root: str, folder: str) -> DataFrame:
    """Committed rows of a landed folder, types voted over all of them when they landed."""
    return L.read_committed(spark, lake_root, folder)


@register("load_roundtrip", PER_MONTH_SQL)
def load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land a mixed-layout gzip lake into a new partitioned gzip lake, read it back typed (K1, K8)."""
    lake_root = shared_dir(spark, "loaded")
    L.land(spark, _landing_rows(spark, sf_dir), lake_root, "orders")
    return _per_month(_read_back(spark, lake_root, "orders"))


@register("load_idempotent", PER_MONTH_SQL)
def load_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing files loaded twice land once: the log skips known files (K3)."""
    lake_root = shared_dir(spark, "loaded-twice")
    rows = _landing_rows(spark, sf_dir)
    L.land(spark, rows, lake_root, "orders")
    L.land(spark, rows, lake_root, "orders")
    return _per_month(_read_back(spark, lake_root, "orders"))


@register(
    "load_reconcile",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS source_rows,
              count(*) AS landed_rows, CAST(0 AS BIGINT) AS files_not_ok FROM orders GROUP BY 1""",
)
def load_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per landing file vs rows landed from it, summarised per report date (K4)."""
    lake_root = shared_dir(spark, "reconciled")
    src = _landing_rows(spark, sf_dir)
    L.land(spark, src, lake_root, "orders")
    landed = L.committed(spark, L.read_landed(spark, f"{lake_root}/orders"), lake_root)
    rec = L.reconcile(src, landed)
    per_file_date = src.select("src_file", "report_date").distinct()
    return (
        rec.join(per_file_date, "src_file", "left")
        .groupBy("report_date")
        .agg(
            F.sum("source_rows").alias("source_rows"),
            F.sum("landed_rows").alias("landed_rows"),
            F.count_if(F.col("status") != "ok").alias("files_not_ok"),
        )
    )


@register(
    "load_replace",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date,
              count(*) FILTER (WHERE year(o_orderdate) <> 1996 OR o_orderstatus = 'F') AS n_rows
       FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE year(o_orderdate) <> 1996 OR o_orderstatus = 'F') > 0""",
)
def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace mode puts new rows in the place of the files it brings; other files stay (K6, Q5)."""
    lake_root = shared_dir(spark, "replaced")
    rows = _landing_rows(spark, sf_dir)
    L.land(spark, rows, lake_root, "orders")
    y1996 = rows.where((F.year("report_date") == 1996) & (F.col("order_status") == "F"))
    again = rows.where(F.year("report_date") == 1996).select("src_file", "report_date").distinct()  # also those left without a row
    again = again.select("src_file", N.base_name("src_file").alias("file_name"), "report_date", F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified_at"))
    L.land(spark, y1996, lake_root, "orders", mode="replace", files=again)
    back = _read_back(spark, lake_root, "orders")
    return back.groupBy("report_date").agg(F.count(F.lit(1)).alias("n_rows"))


@register("incremental_ingest", PER_MONTH_SQL)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpointed file stream, run twice: the second run finds nothing new."""
    root = report_lake(spark, sf_dir, "orders")
    schema = infer.infer_lake_schema(spark, root)  # the vote over all rows
    base = shared_dir(spark, "stream")
    sink, ckpt = f"{base}/sink", f"{base}/_checkpoint"
    ingest.run_once(spark, root, schema, sink, ckpt)
    second = ingest.run_once(spark, root, schema, sink, ckpt)
    if second != 0:
        raise AssertionError(f"second incremental run read {second} rows, expected 0")
    return _per_month(spark.read.parquet(sink))


@register("upload_new_files", PER_MONTH_SQL)
def upload_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upload command end to end: list a flat landing folder of named report files, build the
    catalog, land 1995 first, then everything with the header audit: only files not in the log
    land, each under the report date its name carries (S1, S9, S15, J2 at file level, K1-K5)."""
    listing = C.list_files(spark, landing_files(spark, sf_dir))
    cat = C.build_catalog(listing, [LANDING_SPEC])
    lake_root = shared_dir(spark, "uploaded")
    L.upload(spark, cat.where(F.year("report_date") == 1995), lake_root)
    res = L.upload(spark, cat, lake_root).collect()  # one row per folder
    if any(r["quarantined"] or r["failed"] for r in res):
        raise AssertionError("a landing file was quarantined or failed")
    folder = f"{LANDING_SPEC.storage_folder_name}_v1-0"
    return _per_month(_read_back(spark, lake_root, folder))


_AWKWARD = ("plain", "with space", "per%cent", "plus+plus", "hash#mark", "\u00fcml\u00e4ut")
#: Orders of one bucket: a file holds a bucket's orders of one owner and month, so files follow the rows.
BUCKET_KEYS = 200_000
_FILES_SQL = f"""d AS (SELECT o_orderkey % 6 AS k, last_day(CAST(o_orderdate AS DATE)) AS m, o_orderkey // {BUCKET_KEYS} AS b FROM orders),
f AS (SELECT k, m, b, count(*) AS n FROM d GROUP BY k, m, b),
one AS (SELECT coalesce(sum(n), 0) AS n, count(*) AS files FROM f)"""
ACCOUNTING_SQL = f"""WITH {_FILES_SQL}
SELECT status, CAST(files AS BIGINT) AS files, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT 'ok' AS status, 3 * files + 2 AS files, 3 * n AS n_rows FROM one
  UNION ALL SELECT 'skipped', 2 * files + 1, 0 FROM one UNION ALL SELECT 'rejected', 4, 0 UNION ALL SELECT 'duplicate', 2, 0 UNION ALL SELECT 'quarantined', 2, 0)"""
STREAM_SQL = f"""WITH {_FILES_SQL}
SELECT status, CAST(files AS BIGINT) AS files, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT 'ok' AS status, 3 * files + 2 AS files, 3 * n AS n_rows FROM one
  UNION ALL SELECT 'rejected', 4, 0 UNION ALL SELECT 'duplicate', 2, 0 UNION ALL SELECT 'quarantined', 2, 0)"""
_EXTRA = [
    ("ledger__199501__header__d1.csv.gz", "key,note,price\n"), ("stock__199501__header__d1.csv.gz", "key,note,price\n"),
    ("copy/ledger__199501__header__d1.csv.gz", "key,note,price\n"), ("copy/stock__199501__header__d1.csv.gz", "key\n"),
    ("ledger__199513__bad__d1.csv.gz", "key\n"), ("ledger-note.csv.gz", "key\n"), ("stock__199502__plain__d1.csv", "key\n"), ("stock__199502__packed__d1.csv.zip", "key\n"),
    ("ledger__199502__foreign__d1.csv.gz", "alpha,beta\n1,2\n"), ("stock__199502__foreign__d1.csv.gz", "alpha,beta\n1,2\n"),
]
_SPECS = [s for s in FIXTURE_SPECS if s.source_id in ("ledger", "stock", "tariff")]


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cells of a report: owner, month, bucket, key, note (with quotes, a comma and a line break), price."""
    o = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate", "o_totalprice"))
    owner = F.element_at(F.array(*[F.lit(x) for x in _AWKWARD]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    text = F.concat(F.lit('"say ""'), F.col("o_orderkey").cast("string"), F.lit('"",\n ok"'))
    return o.select(
        owner.alias("owner"), F.date_format("o_orderdate", "yyyyMM").alias("ym"), (F.col("o_orderkey") / BUCKET_KEYS).cast("long").alias("bucket"),
        F.col("o_orderkey").cast("string").alias("key"), text.alias("note"), F.format_string("%.2f", "o_totalprice").alias("price"))


def _file_of(line: Column) -> Column:
    """Lines of a group as the text of one file; a bucket bounds them."""
    return F.array_join(F.collect_list(line), "\n")


def _awkward_landing(spark: SparkSession, sf_dir: str, root: str, owners: tuple[str, ...], extra: bool) -> None:
    """Landing files under awkward names, one an (owner, month, bucket) and family: ``ledger`` with a title
    row, ``stock`` with its columns in another order and one more, ``tariff`` plain; and, with
    ``extra``, files that can't land, are empty but for a header, or come twice."""
    lines = _order_lines(spark, sf_dir).where(F.col("owner").isin(*owners)).groupBy("owner", "ym", "bucket").agg(
        _file_of(F.concat_ws(",", "key", "note", "price")).alias("ledger"),
        _file_of(F.concat_ws(",", "price", "key", "note", F.lit("x"))).alias("stock"),
    )
    files = []
    for family, column, head in (("ledger", "ledger", "Title\nkey,note,price\n"), ("stock", "stock", "price,key,note,extra\n"), ("tariff", "ledger", "key,note,price\n")):
        name = F.concat(F.lit(f"{family}__"), "ym", F.lit("__"), "owner", F.lit("__d1"), F.col("bucket").cast("string"), F.lit(".csv.gz"))
        files.append(F.struct(name.alias("name"), F.concat(F.lit(head), column, F.lit("\n")).alias("content")))
    if extra:
        write_named_gzip(spark.createDataFrame(_EXTRA, "name string, content string"), root)
    write_named_gzip(lines.select(F.inline(F.array(*files))), root)


def _accounted(spark: SparkSession, lake_root: str) -> DataFrame:
    """Files and rows per status of a load log; rows of ``ok`` files are those whose note came through whole."""
    log = L.read_log(spark, lake_root)
    landed = [L.committed(spark, L.read_landed(spark, f"{lake_root}/{r[0]}"), lake_root) for r in log.where("status = 'ok'").select("storage_folder_name").distinct().collect()]
    notes = [r.agg(F.count_if(F.col("note") == F.concat(F.lit('say "'), F.col("key"), F.lit('",\n ok'))).alias("n")).first()["n"] for r in landed]
    found = log.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("logged"))
    return found.select("status", "files", F.when(F.col("status") == "ok", F.lit(int(sum(notes)))).otherwise(F.col("logged")).cast("bigint").alias("n_rows"))


@register("upload_accounting", ACCOUNTING_SQL)
def upload_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of a landing tree with awkward names, other headers, titles, header-only files, bad
    names, wrong extensions, foreign headers and repeated names ends in the load log under one
    status; a second upload of part of it is skipped (K1-K7)."""
    root, lake_root = shared_dir(spark, "awkward"), shared_dir(spark, "accounted")
    _awkward_landing(spark, sf_dir, root, _AWKWARD, True)
    cat = C.build_catalog(C.list_files(spark, root), _SPECS)
    L.upload(spark, cat, lake_root)
    L.upload(spark, cat.where(F.col("error").isNull() & F.col("source_id").isin("ledger", "tariff") & ~F.col("file_name").contains("foreign") & ~F.col("file_dir").endswith("copy")), lake_root)
    return _accounted(spark, lake_root)


@register("stream_accounting", STREAM_SQL)
def stream_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of ``upload_accounting`` as a stream through the load log: two arrivals, the second with
    drifted, foreign, bad and repeated files, then its batch once more as after a crash (R1)."""
    root, lake_root = shared_dir(spark, "arrivals"), shared_dir(spark, "streamed")
    checkpoint = shared_dir(spark, "arrivals-checkpoint")
    _awkward_landing(spark, sf_dir, root, _AWKWARD[:3], False)
    ingest.run_uploads(spark, root, _SPECS, lake_root, checkpoint)
    first = C.list_files(spark, root)
    first.select("path").write.parquet(f"{checkpoint}-first")
    _awkward_landing(spark, sf_dir, root, _AWKWARD[3:], True)
    ingest.run_uploads(spark, root, _SPECS, lake_root, checkpoint)
    second = C.list_files(spark, root).join(spark.read.parquet(f"{checkpoint}-first"), "path", "left_anti")
    last = L.read_log(spark, lake_root).agg(F.max(F.substring("load_id", len("stream-") + 1, 9)).alias("n")).first()["n"]
    batch = L.read_log(spark, lake_root).where(F.col("load_id").startswith(f"stream-{last}")).select("src_file").distinct()
    again = second.withColumn("src_file", csvlake.plain_path(F.col("path"))).join(batch, "src_file", "left_semi").drop("src_file")
    ingest.upload_batch(again, int(last), _SPECS, lake_root, "stream")
    # a name that comes again in a later batch is skipped there, in the same batch it is a duplicate
    found = _accounted(spark, lake_root).withColumn("status", F.when(F.col("status") == "skipped", "duplicate").otherwise(F.col("status")))
    return found.groupBy("status").agg(F.sum("files").alias("files"), F.sum("n_rows").alias("n_rows"))


@register(
    "land_same_names",
    """SELECT CAST(o_orderkey % 3 AS BIGINT) AS drop_folder, last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_rows, sum(o_orderkey) AS sum_key
       FROM orders WHERE o_orderkey % 3 <> 1 OR o_orderstatus = 'F' GROUP BY 1, 2""",
)
def land_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one name in three drop folders are three files; those of one folder are replaced, with
    fewer rows or none, and the others stay (K3, K6)."""
    lake_root = shared_dir(spark, "same-names")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = F.concat(F.lit("/drop/"), (F.col("o_orderkey") % 3).cast("string"), F.lit("/orders__"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv.gz"))
    rows = o.select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderstatus").alias("status_cell"), path.alias("src_file"), F.last_day(F.to_date("o_orderdate")).alias("report_date"))
    L.land(spark, rows, lake_root, "orders")
    one = rows.where(F.col("src_file").startswith("/drop/1/"))
    files = one.select("src_file", "report_date").distinct().select("src_file", N.base_name("src_file").alias("file_name"), "report_date", F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified_at"))
    L.land(spark, one.where("status_cell = 'F'"), lake_root, "orders", mode="replace", files=files)
    L.land(spark, rows, lake_root, "orders")  # all are known
    back = L.committed(spark, L.read_landed(spark, f"{lake_root}/orders"), lake_root)
    return back.groupBy(F.regexp_extract("src_file", "^/drop/([0-9])/", 1).cast("bigint").alias("drop_folder"), "report_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("key").cast("bigint")).alias("sum_key"))


@register(
    "landed_digest",
    """SELECT CAST(o_orderkey % 5 AS BIGINT) AS part, last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS logged_rows,
              count(*) FILTER (WHERE o_orderkey % 1009 <> 5) AS landed_rows,
              CASE WHEN count(*) FILTER (WHERE o_orderkey % 1009 <> 5) = 0 THEN 'missing' WHEN bool_or(o_orderkey % 1009 = 5) THEN 'count_mismatch'
                   WHEN bool_or(o_orderkey % 1000 = 7) THEN 'changed' ELSE 'ok' END AS status
       FROM orders GROUP BY 1, 2""",
)
def landed_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests a load keeps against rows with planted harm: a cell changed here and there, rows lost
    elsewhere; every file is judged, whatever the order of its rows (K4)."""
    lake_root = shared_dir(spark, "digested")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = F.concat(F.lit("/drop/part"), (F.col("o_orderkey") % 5).cast("string"), F.lit("/orders__"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv.gz"))
    rows = o.select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("string").alias("price"), path.alias("src_file"), F.last_day(F.to_date("o_orderdate")).alias("report_date"))
    L.land(spark, rows, lake_root, "orders")
    key = F.col("key").cast("bigint")
    landed = L.read_landed(spark, f"{lake_root}/orders").where(key % 1009 != 5)
    harmed = landed.withColumn("priority", F.when(key % 1000 == 7, F.concat("priority", F.lit("!"))).otherwise(F.col("priority")))
    found = L.verify(spark, lake_root, "orders", harmed)
    return found.select(F.regexp_extract("src_file", "part([0-9])", 1).cast("bigint").alias("part"), "report_date", "logged_rows", "landed_rows", "status")


@register(
    "schema_from_log",
    """WITH r AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 1 OR o_orderstatus = 'F'),
    c AS (SELECT 0 AS position, 'key' AS column_name, count(*) AS n_non_null, 'INT64' AS t, 10 AS least FROM r
          UNION ALL SELECT 1, 'price', count(*), 'BIGNUMERIC', 10 FROM r
          UNION ALL SELECT 2, 'day', count(*), 'DATE', 10 FROM r
          UNION ALL SELECT 3, 'urgent', count(*), 'BOOL', 10 FROM r
          UNION ALL SELECT 4, 'late', count(*) FILTER (WHERE o_orderkey % 3 = 2), 'INT64', 10 FROM r)
    SELECT CAST(position AS BIGINT) AS position, column_name, n_non_null, CASE WHEN n_non_null < least THEN 'STRING' ELSE t END AS inferred_type,
           TRUE AS equals_scan, CAST(0 AS BIGINT) AS data_files_read FROM c""",
)
def schema_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed schema of a folder from the counts its loads kept: a column that a later load brought, a
    replaced file that doesn't count any more, equal to a vote over all committed rows, without
    reading a data file (I2, I6)."""
    lake_root = shared_dir(spark, "counted")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = F.concat(F.lit("/drop/"), (F.col("o_orderkey") % 3).cast("string"), F.lit("/orders__"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv.gz"))
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", "yes").otherwise("no")
    rows = o.select(F.col("o_orderkey").cast("string").alias("key"), F.format_string("%.2f", F.col("o_totalprice") + 0.005).alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), urgent.alias("urgent"), F.col("o_orderstatus").alias("s"), path.alias("src_file"), F.last_day(F.to_date("o_orderdate")).alias("report_date"))
    part = lambda k: rows.where(F.col("src_file").startswith(f"/drop/{k}/"))
    L.land(spark, part(0).drop("s"), lake_root, "orders")
    L.land(spark, part(1).drop("s").withColumn("key", F.lit("no number")), lake_root, "orders")
    L.land(spark, part(2).drop("s").withColumn("late", F.col("key")), lake_root, "orders")
    files = part(1).select("src_file", "report_date").distinct().select("src_file", N.base_name("src_file").alias("file_name"), "report_date", F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified_at"))
    L.land(spark, part(1).where("s = 'F'").drop("s"), lake_root, "orders", mode="replace", files=files)
    kept = infer.decide(L.folder_profile(spark, lake_root, "orders"))
    read = sum(f"{lake_root}/orders/report_date=" in f for f in kept.inputFiles())
    columns = L.folder_columns(spark, f"{lake_root}/orders")
    scanned = infer.decide(infer.profile(L.committed(spark, L.read_landed(spark, f"{lake_root}/orders"), lake_root), columns))
    same = F.struct(*[F.col(f"k.{c}") for c in ["n_non_null", *infer.COUNT_COLUMNS, "inferred_type"]]) == F.struct(*[F.col(f"s.{c}") for c in ["n_non_null", *infer.COUNT_COLUMNS, "inferred_type"]])
    both = kept.alias("k").join(scanned.alias("s"), F.col("k.column_name") == F.col("s.column_name"), "full_outer")
    return both.select(F.col("k.position").alias("position"), F.col("k.column_name").alias("column_name"), F.col("k.n_non_null").alias("n_non_null"), F.col("k.inferred_type").alias("inferred_type"), same.alias("equals_scan"), F.lit(read).cast("bigint").alias("data_files_read"))
