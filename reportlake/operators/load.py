"""Landing report files into a lake (K1-K8): plan, accounting, write, verify, log, reconcile, replace.

A load moves the rows of new landing files to ``<lake>/<folder>/report_date=D/load_id=L/`` as gzip CSV
(or Parquet); undated files go to ``<folder>/load_id=L/``. Every load has its own directories, so a
write never touches another load's files. The load log (Parquet, append-only) has one row for each
file of a load with its status: ``ok``, ``rejected``, ``duplicate``, ``skipped``, ``quarantined`` or
``failed``. It is appended last, which commits the load.

A file is known by one identity everywhere: its folder and its ``file_key``, which is its path unless the
caller declares a logical name (``upload`` takes the bare name, as new files are told by it). Each
``ok`` entry of an identity has a version, one above the last. ``committed`` keeps the rows that the
entries of the newest version point to: a crashed load isn't in the log, and a replaced file's old rows
aren't of its newest version, so both stay out of sight without deleting anything, while two files of
one name from different paths are two files.

What lands is checked against its source before it is logged: the rows' digest (their number and the
sums of two hashes, so in any order) is taken while they are written and again from what was written.
The log keeps the digest of each file, so ``verify`` can repeat the check at any time.

The columns of a folder are kept beside its data (``_schema``) and only ever grow at the end: files
with other headers are landed by column name, and older files read NULL in newer columns.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.functions import names as N
from reportlake.operators import catalog as C
from reportlake.operators import infer
from reportlake.session import shared_dir
from reportlake.sources import archives, csvlake
from reportlake.sources.specs import SourceSpec

LOG_DIR = "_load_log"
LOG_SCHEMA = (
    "load_id string, storage_folder_name string, src_file string, file_name string, report_date date, rows bigint, "
    "bytes bigint, modified_at timestamp, status string, reason string, started_at timestamp, finished_at timestamp, "
    "file_key string, version bigint, digest string"
)
FILE_SCHEMA = "src_file string, file_name string, report_date date, bytes bigint, modified_at timestamp, file_key string"
#: Catalog columns that a plan takes.
PLANNED = ("file_path", "file_name", "storage_folder_name", "report_date", "report_date_str", "table_append_or_replace", "file_size_in_bytes", "modified_at", "error")
#: Files of one pass of ``upload``: the driver holds that many paths at most.
FILES_PER_PASS = 100_000


def _wrong_extension() -> Column:
    """Dated files must be ``.csv.gz``; undated ones ``.csv`` or ``.csv.gz`` (K5, K8)."""
    gz = F.col("file_name").endswith(".csv.gz")
    return F.when(F.col("report_date_str").isNotNull(), ~gz).otherwise(~(gz | F.col("file_name").endswith(".csv")))


def load_rejects(catalog: DataFrame) -> DataFrame:
    """Dated files must be ``.csv.gz`` to land in a partitioned folder; others are rejected (K5)."""
    bad = F.col("report_date_str").isNotNull() & ~F.col("file_name").endswith(".csv.gz")
    return catalog.where(bad).withColumn("reason", F.lit("bad_extension"))


def plan_summary(catalog: DataFrame) -> DataFrame:
    """Per table: files, bytes, MB, files that can land and files rejected."""
    bad = F.col("report_date_str").isNotNull() & ~F.col("file_name").endswith(".csv.gz")
    return catalog.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size_in_bytes").alias("total_bytes"),
        F.round(F.sum("file_size_in_bytes") / F.lit(1048576.0), 2).alias("total_mb"),
        F.count_if(~bad).alias("ok"),
        F.count_if(bad).alias("failed"),
    )


def throughput(log: DataFrame) -> DataFrame:
    """Summary of a load log: files, MB, seconds, MB/s (zero-guarded), ok, failed (K7)."""
    return log.groupBy("load_id").agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.sum("bytes") / F.lit(1048576.0), 2).alias("total_mb"),
        (F.max("finished_at").cast("double") - F.min("started_at").cast("double")).alias("seconds"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") != "ok").alias("failed"),
    ).withColumn(
        "mb_per_s", F.when(F.col("seconds") > 0, F.round(F.col("total_mb") / F.col("seconds"), 2)).otherwise(0.0)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_log(spark: SparkSession, lake_root: str) -> DataFrame | None:
    """The load log, or None before the first load."""
    if not path_exists(spark, f"{lake_root}/{LOG_DIR}"):
        return None
    return spark.read.schema(LOG_SCHEMA).parquet(f"{lake_root}/{LOG_DIR}")


def _identified(log: DataFrame) -> DataFrame:
    """``ok`` entries; those written without an identity are known by their path."""
    ok = log.where("status = 'ok'").withColumn("file_key", F.coalesce("file_key", "src_file"))
    return ok.withColumn("version", F.coalesce("version", F.lit(0)))


def current_files(log: DataFrame) -> DataFrame:
    """All ``ok`` entries of the newest version of each file (replaced entries drop out)."""
    ok = _identified(log)
    entry = F.struct("version", "finished_at", "load_id")
    newest = ok.groupBy("storage_folder_name", "file_key").agg(F.max(entry).alias("e"))
    newest = newest.select("storage_folder_name", "file_key", F.col("e.load_id").alias("load_id"))
    return ok.join(newest, ["storage_folder_name", "file_key", "load_id"], "left_semi")


def not_loaded(spark: SparkSession, rows: DataFrame, lake_root: str, folder: str | None = None, key: str = "src_file") -> DataFrame:
    """Rows of files whose identity (``key``) has no ``ok`` entry (of ``folder``) in the load log yet (K3)."""
    log = read_log(spark, lake_root)
    if log is None:
        return rows
    done = _identified(log)
    if folder is not None:
        done = done.where(F.col("storage_folder_name") == folder)
    return rows.join(done.select(F.col("file_key").alias(key)).distinct(), key, "left_anti").select(*rows.columns)


def committed(spark: SparkSession, rows: DataFrame, lake_root: str) -> DataFrame:
    """Rows that the newest version of their file points to: no leftovers of crashed loads, no
    replaced rows."""
    log = read_log(spark, lake_root)
    if log is None:
        return rows.where(F.lit(False))
    return rows.join(current_files(log).select("load_id", "src_file").distinct(), ["load_id", "src_file"], "left_semi").select(*rows.columns)


def _row_hashes(columns: list[str]) -> list[Column]:
    text = F.concat_ws("\u0001", *[F.concat(F.lit(f"{c}\u0002"), F.col(c)) for c in columns])
    return [F.xxhash64(text), F.hash(text)]


def row_digest(columns: list[str]) -> list[Column]:
    """Two hashes of a row's named cells that aren't null, so a column added later changes nothing."""
    return [h.cast("decimal(38,0)") for h in _row_hashes(columns)]


def _digest_sums(columns: list[str]) -> list[Column]:
    one, two = row_digest(columns)
    zero = F.lit(0).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(one), zero).alias("d1"), F.coalesce(F.sum(two), zero).alias("d2")]


def _digest_text() -> Column:
    return F.concat_ws(":", F.col("d1").cast("string"), F.col("d2").cast("string"))


def digests(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Per group: rows and the digest of their cells, in any order (K4)."""
    return rows.groupBy(*by).agg(*_digest_sums(columns)).select(*by, "rows", _digest_text().alias("digest"))


def folder_profile(spark: SparkSession, lake_root: str, folder: str) -> DataFrame:
    """The profile of a landed folder (``infer.profile``) from the counts kept with its loads: those of
    current files add up, replaced and crashed ones don't count, and no data file is read (I2, I6)."""
    dest = f"{lake_root}/{folder}"
    current = current_files(read_log(spark, lake_root)).where(F.col("storage_folder_name") == folder).select("load_id", "src_file").distinct()
    kept = spark.read.schema(f"load_id string, src_file string, column_name string, position bigint, n_non_null bigint, {', '.join(f'{c} bigint' for c in infer.COUNT_COLUMNS)}").parquet(f"{dest}/{PROFILE_DIR}")
    names = spark.createDataFrame([(c, i) for i, c in enumerate(folder_columns(spark, dest))], "column_name string, place bigint")
    counted = infer.merged(kept.join(current, ["load_id", "src_file"], "left_semi"))
    counted = names.join(counted.drop("position"), "column_name", "left").withColumnRenamed("place", "position")
    return counted.select("column_name", "position", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["n_non_null", *infer.COUNT_COLUMNS]])


def read_committed(spark: SparkSession, lake_root: str, folder: str, fmt: str = "csv", on_error: str = "quarantine") -> DataFrame:
    """The committed rows of a landed folder, typed by the vote over all of them that the loads kept."""
    dest = f"{lake_root}/{folder}"
    columns = folder_columns(spark, dest)
    types = {r["column_name"]: r["inferred_type"] for r in infer.decide(folder_profile(spark, lake_root, folder)).collect()}
    return csvlake.apply_types(committed(spark, read_landed(spark, dest, fmt), lake_root), columns, [types[c] for c in columns], on_error)


def verify(spark: SparkSession, lake_root: str, folder: str, landed: DataFrame | None = None, fmt: str = "csv") -> DataFrame:
    """Every current file of a folder: logged and found rows and whether the found rows have the digest
    that was logged (K4): ``ok``, ``missing``, ``count_mismatch`` or ``changed``."""
    dest = f"{lake_root}/{folder}"
    landed = read_landed(spark, dest, fmt) if landed is None else landed
    # the columns the folder had at the load: later ones are null in its rows and don't count
    found = digests(landed, folder_columns(spark, dest), ["load_id", "src_file", N.PARTITION_KEY])
    found = found.select("load_id", "src_file", F.col(N.PARTITION_KEY).alias("found_date"), F.col("rows").alias("found_rows"), F.col("digest").alias("found_digest"))
    logged = current_files(read_log(spark, lake_root)).where(F.col("storage_folder_name") == folder)
    same = (logged["load_id"] == found["load_id"]) & (logged["src_file"] == found["src_file"]) & logged["report_date"].eqNullSafe(found["found_date"])
    j = logged.join(found, same, "left")
    n = F.coalesce("found_rows", F.lit(0))
    status = (
        F.when((n == F.col("rows")) & (F.col("rows") == 0), "ok").when(n == 0, "missing").when(n != F.col("rows"), "count_mismatch")
        .when(F.col("found_digest") != F.col("digest"), "changed").otherwise("ok")
    )
    return j.select(logged["src_file"], "file_name", logged["report_date"], F.col("rows").alias("logged_rows"), n.alias("landed_rows"), status.alias("status"))


folder_columns = csvlake.folder_columns
SCHEMA_DIR = csvlake.SCHEMA_DIR
PROFILE_DIR = "_profile"  # beside landed data: class counts of every file's columns


def _extended_columns(spark: SparkSession, dest: str, columns: list[str]) -> list[str]:
    known = folder_columns(spark, dest)
    new = [c for c in columns if c not in known]
    if new:
        rows = [(len(known) + i, c) for i, c in enumerate(new)]
        spark.createDataFrame(rows, "position int, column_name string").coalesce(1).write.mode("append").parquet(f"{dest}/{SCHEMA_DIR}")
    return known + new


def write_rows(rows: DataFrame, dest: str, partitions: list[str], fmt: str = "csv", max_records_per_file: int = 5_000_000) -> None:
    """Write rows under the given partition columns (K1, K8).

    No shuffle: each task writes the dates it holds (landing input is one task per gzip file), and
    ``maxRecordsPerFile`` bounds file size.
    """
    w = rows.write.partitionBy(*partitions).option("maxRecordsPerFile", max_records_per_file).mode("append")
    if fmt == "csv":
        w.options(**csvlake.CSV_WRITE).csv(dest)
    elif fmt == "parquet":
        w.parquet(dest)
    else:
        raise ValueError("fmt must be csv or parquet")


def read_landed(spark: SparkSession, dest: str, fmt: str = "csv", load_id: str | None = None) -> DataFrame:
    """All landed rows of a destination folder as text, or those of one load."""
    columns = folder_columns(spark, dest)
    fields = [T.StructField(c, T.StringType()) for c in ["src_file", *columns]]
    fields += [T.StructField(N.PARTITION_KEY, T.DateType()), T.StructField("load_id", T.StringType())]
    reader = spark.read.schema(T.StructType(fields))
    if fmt == "csv":
        reader = reader.options(**csvlake.CSV_READ)
    paths = [dest]
    if load_id is not None:  # this load's own directories, dated and undated
        reader = reader.option("basePath", dest)
        paths = _existing(spark, [f"{dest}/{N.PARTITION_KEY}=*/load_id={load_id}", f"{dest}/load_id={load_id}"])
        if not paths:
            return spark.createDataFrame([], T.StructType(fields))
    return reader.csv(paths) if fmt == "csv" else reader.parquet(*paths)


def _existing(spark: SparkSession, globs: list[str]) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(globs[0].split("*")[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    return [g for g in globs if fs.globStatus(path(g))]


def land(
    spark: SparkSession,
    rows: DataFrame,
    lake_root: str,
    folder: str,
    mode: str = "append",
    fmt: str = "csv",
    load_id: str | None = None,
    files: DataFrame | None = None,
    key: str = "src_file",
) -> str:
    """Land rows of landing files into ``lake_root/folder``, check and log them (K1-K4, K6).

    ``rows`` carry ``src_file``, ``report_date`` and data columns. A file is known by ``key``, a column of
    ``rows`` (its path, or a declared logical name that isn't landed as data). ``append`` leaves out files
    that the log has already; ``replace`` lands them again as a new version that takes the old one's
    place. ``files`` (FILE_SCHEMA), when given, is what gets logged, so files without rows are logged too
    and their ``file_key`` holds. Rows and digests per file are taken from what was written; if they
    don't add up to what was sent, nothing is logged and an error is raised.
    """
    if mode not in ("append", "replace"):
        raise ValueError("mode must be append or replace")
    load_id = load_id or f"load-{uuid.uuid4().hex}"
    dest = f"{lake_root}/{folder}"
    started = dt.datetime.now(dt.timezone.utc)  # aware: PySpark turns it into the right instant in any zone
    fresh = not_loaded(spark, rows, lake_root, folder, key) if mode == "append" else rows
    data = [c for c in fresh.columns if c not in ("src_file", N.PARTITION_KEY, "load_id", key)]
    columns = _extended_columns(spark, dest, data)
    shaped = fresh.select("src_file", *[F.col(c).cast("string").alias(c) if c in data else F.lit(None).cast("string").alias(c) for c in columns], N.PARTITION_KEY)
    seen = Observation()
    shaped = shaped.observe(seen, *_digest_sums(columns))
    undated_folder = files is not None and not files.where(F.col("report_date").isNotNull()).head(1)
    if undated_folder:
        write_rows(shaped.drop(N.PARTITION_KEY).withColumn("load_id", F.lit(load_id)), dest, ["load_id"], fmt)
    else:
        write_rows(shaped.withColumn("load_id", F.lit(load_id)), dest, [N.PARTITION_KEY, "load_id"], fmt)
    finished = dt.datetime.now(dt.timezone.utc)
    landed = read_landed(spark, dest, fmt, load_id) if seen.get["rows"] else read_landed(spark, dest, fmt).limit(0)
    # one pass over what was written: rows, digests and the class counts of every column, per file
    kept = f"{dest}/{PROFILE_DIR}/load_id={load_id}"
    hashes = dict(zip(("d1", "d2"), _row_hashes(columns)))
    found = infer.profile_by(landed.withColumns(hashes), columns or ["src_file"], ["src_file", N.PARTITION_KEY], list(hashes)).withColumn("digest", _digest_text())
    found.drop("d1", "d2").write.mode("overwrite").parquet(kept)
    first = F.col("position") == 0
    counts = spark.read.schema(found.drop("d1", "d2").schema).parquet(kept).where(first).select("src_file", N.PARTITION_KEY, "rows", "digest")
    d = F.split("digest", ":")
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[F.coalesce(F.sum(d[i].cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias(f"d{i + 1}") for i in (0, 1)]).first()
    if any(total[c] != seen.get[c] for c in ("rows", "d1", "d2")):
        raise ValueError(f"load {load_id} of {folder} isn't logged: {seen.get['rows']} rows sent, {total['rows']} found, digests {'equal' if total['d1'] == seen.get['d1'] else 'differ'}")
    if files is None:
        named = fresh.select("src_file", F.col(key).alias("file_key")).distinct() if key != "src_file" else None
        entries = counts.select("src_file", N.base_name("src_file").alias("file_name"), F.col(N.PARTITION_KEY).alias("report_date"), "rows", F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified_at"), "digest")
        entries = entries.join(named, "src_file") if named is not None else entries.withColumn("file_key", F.col("src_file"))
    else:
        dates = counts.withColumnRenamed(N.PARTITION_KEY, "landed_date")
        identity = F.col("file_key") if "file_key" in files.columns else F.col("src_file")
        entries = files.withColumn("file_key", F.coalesce(identity, F.col("src_file"))).join(dates, "src_file", "left")
        entries = entries.select("src_file", "file_name", F.when(F.col("rows") > 0, F.col("landed_date")).otherwise(F.col("report_date")).alias("report_date"), F.coalesce("rows", F.lit(0)).alias("rows"), "bytes", "modified_at", F.coalesce("digest", F.lit("0:0")).alias("digest"), "file_key")
    log = read_log(spark, lake_root)
    last = spark.createDataFrame([], "file_key string, last bigint")
    if log is not None:
        last = _identified(log).where(F.col("storage_folder_name") == folder).groupBy("file_key").agg(F.max("version").alias("last"))
    entries = entries.join(last, "file_key", "left").withColumn("version", F.coalesce("last", F.lit(0)) + 1)
    append_log(entries.select(
        F.lit(load_id).alias("load_id"), F.lit(folder).alias("storage_folder_name"), "src_file", "file_name", "report_date", F.col("rows"), "bytes", "modified_at", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("reason"),
        F.lit(started).cast("timestamp").alias("started_at"), F.lit(finished).cast("timestamp").alias("finished_at"), "file_key", "version", "digest"), lake_root)
    return load_id


def append_log(entries: DataFrame, lake_root: str) -> None:
    names = [f.name for f in T._parse_datatype_string(LOG_SCHEMA)]
    entries.select(*names).write.mode("append").parquet(f"{lake_root}/{LOG_DIR}")


def reconcile(source_rows: DataFrame, landed_rows: DataFrame, key: str = "src_file") -> DataFrame:
    """Rows per file at the source vs in the lake; full outer join, status per file (K4)."""
    s = source_rows.groupBy(key).agg(F.count(F.lit(1)).alias("source_rows"))
    d = landed_rows.groupBy(key).agg(F.count(F.lit(1)).alias("landed_rows"))
    j = s.join(d, key, "full_outer").select(
        key,
        F.coalesce("source_rows", F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce("landed_rows", F.lit(0)).cast("bigint").alias("landed_rows"),
    )
    return j.withColumn(
        "status",
        F.when(F.col("source_rows") == F.col("landed_rows"), F.lit("ok"))
        .when(F.col("landed_rows") == 0, F.lit("missing"))
        .when(F.col("source_rows") == 0, F.lit("unexpected"))
        .otherwise(F.lit("count_mismatch")),
    )


def plan_upload(spark: SparkSession, catalog: DataFrame, lake_root: str, mode: str | None = None, recompress: bool = False) -> DataFrame:
    """Every catalog row with what an upload will do with it: ``new``, ``rejected``, ``duplicate`` (the
    same name of a folder again; the first path stays) or ``skipped`` (its bare name is loaded
    already; in replace mode, with the same size and time). With ``recompress`` plain dated CSV files
    are taken too, under the name they would have compressed."""
    name = F.col("file_name")
    plain = F.lit(recompress) & name.endswith(".csv")
    plan = catalog.select(
        csvlake.plain_path(F.col("file_path")).alias("src_file"), "file_name", "storage_folder_name", "report_date",
        F.coalesce(F.lit(mode), F.col("table_append_or_replace"), F.lit("append")).alias("mode"),
        F.col("file_size_in_bytes").alias("bytes"), F.col("modified_at").cast("timestamp").alias("modified_at"),
        F.coalesce(F.col("error"), F.when(_wrong_extension() & ~plain, F.lit("bad_extension"))).alias("reason"),
        F.when(plain, F.concat(name, F.lit(".gz"))).otherwise(name).alias("file_key"),
    )
    group = ["storage_folder_name", "file_key"]
    first = plan.where("reason IS NULL").groupBy(*group).agg(F.min("src_file").alias("first_path"))
    plan = plan.join(first, group, "left")
    log = read_log(spark, lake_root)
    if log is None:
        plan = plan.withColumn("done", F.lit(False))
    else:
        entry = F.struct("finished_at", "bytes", "modified_at")
        done = log.where("status = 'ok'").withColumn("file_key", F.when(F.col("file_key") == F.concat("file_name", F.lit(".gz")), F.col("file_key")).otherwise(F.col("file_name")))
        done = done.groupBy(*group).agg(F.max(entry).alias("e"))
        same = F.col("e.bytes").eqNullSafe(F.col("bytes")) & F.col("e.modified_at").eqNullSafe(F.col("modified_at"))
        plan = plan.join(done, group, "left").withColumn("done", F.col("e").isNotNull() & ((F.col("mode") == "append") | same)).drop("e")
    status = (
        F.when(F.col("reason").isNotNull(), "rejected").when(F.col("src_file") != F.col("first_path"), "duplicate")
        .when(F.col("done"), "skipped").otherwise("new")
    )
    return plan.withColumn("status", status).drop("first_path", "done")


def _log_others(spark: SparkSession, rows: DataFrame, lake_root: str, load_id: str) -> None:
    """Log files that did not land (status and reason set), with 0 rows."""
    now = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    key = F.col("file_key") if "file_key" in rows.columns else F.col("src_file")
    append_log(rows.select(F.lit(load_id).alias("load_id"), "storage_folder_name", "src_file", "file_name", "report_date", F.lit(0).cast("bigint").alias("rows"), "bytes", "modified_at", "status", "reason", now.alias("started_at"), now.alias("finished_at"), key.alias("file_key"), F.lit(None).cast("bigint").alias("version"), F.lit(None).cast("string").alias("digest")), lake_root)


def upload(
    spark: SparkSession,
    catalog: DataFrame,
    lake_root: str,
    mode: str | None = None,
    fmt: str = "csv",
    on_drift: str = "evolve",
    recompress: bool = False,
    load: str | None = None,
    files_per_pass: int = FILES_PER_PASS,
) -> DataFrame:
    """Land the new files of a catalog into ``lake_root/<storage_folder_name>/`` (K1-K6, K8).

    Every file of the catalog ends in the load log: landed (``ok``), ``rejected`` (name, date key or
    extension), ``duplicate``, ``skipped`` (loaded before), ``quarantined`` (a header that shares no
    column with its folder's; with ``on_drift='quarantine'`` any other header) or ``failed`` (unreadable).
    The folder's header is that of its landed columns or, at first, of its newest file by report date
    and name; other headers are landed by column name.

    Zip entries (``archives.entry_listing``) are files like others. Each folder's files are read in one
    scan, whatever their headers. Files go in passes of ``files_per_pass``, so the driver holds that
    many paths at most and one header a layout. Returns one row a folder.
    """
    load = load or f"load-{uuid.uuid4().hex}"
    path, kept = shared_dir(spark, "upload-plan"), shared_dir(spark, "upload-catalog")
    csvlake.in_shares(catalog.select(*PLANNED)).write.parquet(kept)  # the plan reads it twice
    plan_upload(spark, spark.read.schema(catalog.select(*PLANNED).schema).parquet(kept), lake_root, mode, recompress).write.parquet(path)
    plan = spark.read.parquet(path)
    _log_others(spark, plan.where("status <> 'new'"), lake_root, load)
    todo = plan.where("status = 'new'")
    passes = -(-todo.count() // files_per_pass)
    for number in range(passes):
        some = todo.where(F.pmod(F.xxhash64("src_file"), F.lit(passes)) == number) if passes > 1 else todo
        _upload_pass(spark, some, lake_root, fmt, on_drift, load)
    folders = plan.where("status = 'new'").select("storage_folder_name").distinct()
    log = read_log(spark, lake_root)
    if log is None:
        return spark.createDataFrame([], "storage_folder_name string, files bigint, rows bigint, quarantined bigint, failed bigint, load_id string")
    mine = log.where(F.col("load_id").startswith(load)).join(folders, "storage_folder_name")
    ok = F.col("status") == "ok"
    return mine.groupBy("storage_folder_name").agg(
        F.count_if(ok).alias("files"), F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).alias("rows"),
        F.count_if(F.col("status") == "quarantined").alias("quarantined"), F.count_if(F.col("status") == "failed").alias("failed"), F.lit(load).alias("load_id"))


def upload_archives(spark: SparkSession, root: str, specs: list[SourceSpec], lake_root: str, max_bytes: int = archives.MAX_UNCOMPRESSED, **options) -> DataFrame:
    """Land the CSV entries of all zip archives under ``root`` as files of their own (S16, K8); archives
    that are bad, too large or without CSV are logged as rejected. Returns what ``upload`` does."""
    load = f"load-{uuid.uuid4().hex}"
    none = F.lit(None).cast("string")
    rejects = archives.archive_rejects(spark, root, max_bytes).select(
        none.alias("storage_folder_name"), "src_file", N.base_name("src_file").alias("file_name"), none.cast("date").alias("report_date"), "bytes", none.cast("timestamp").alias("modified_at"), F.lit("rejected").alias("status"), "reason")
    _log_others(spark, rejects, lake_root, load)
    listing = shared_dir(spark, "entry-listing")
    archives.entry_listing(spark, root, max_bytes).write.parquet(listing)
    return upload(spark, C.build_catalog(spark.read.parquet(listing), specs), lake_root, recompress=True, load=load, **options)


def _upload_pass(spark: SparkSession, todo: DataFrame, lake_root: str, fmt: str, on_drift: str, load: str) -> None:
    paths: dict[tuple[str, str], list[str]] = {}
    for r in todo.select("storage_folder_name", "mode", "src_file").collect():
        paths.setdefault((r["storage_folder_name"], r["mode"]), []).append(r["src_file"])
    entries = [p for some in paths.values() for p in some if archives.is_entry(p)]
    plain = [p for some in paths.values() for p in some if not archives.is_entry(p)]
    heads = [csvlake.file_heads(spark, None, paths=plain)] if plain else []
    if entries:
        heads.append(archives.entry_heads(spark, archives.archive_paths(entries)))
    both = heads[0].unionByName(heads[1]) if len(heads) == 2 else heads[0]
    kept = shared_dir(spark, "upload-heads")
    todo.join(both.withColumnRenamed("file_path", "src_file"), "src_file", "left").write.parquet(kept)
    listed = spark.read.parquet(kept)
    for folder, how in sorted(paths):
        mine = listed.where((F.col("storage_folder_name") == folder) & (F.col("mode") == how))
        _upload_folder(spark, mine, lake_root, folder, how, fmt, on_drift, load)


def _upload_folder(spark: SparkSession, files: DataFrame, lake_root: str, folder: str, mode: str, fmt: str, on_drift: str, load: str) -> None:
    """Quarantine files with foreign headers and land the others in one write; a file that can't be read
    is logged as failed and the others are written without it."""
    known = folder_columns(spark, f"{lake_root}/{folder}")
    if not known:
        order = F.struct(F.coalesce("report_date", F.lit("0001-01-01").cast("date")), "file_name", "src_file", "columns")
        newest = files.where("columns IS NOT NULL").agg(F.max(order).alias("e")).first()["e"]
        known = newest["columns"] if newest else []
    ours = F.array(*[F.lit(c) for c in known]) if known else F.array().cast("array<string>")
    foreign = F.col("columns").isNotNull() & (~F.arrays_overlap("columns", ours) | (F.lit(on_drift == "quarantine") & (F.col("columns") != ours)))
    _log_others(spark, files.where(foreign).withColumn("status", F.lit("quarantined")).withColumn("reason", F.lit("foreign_header")), lake_root, load)
    broken = ~F.coalesce("readable", F.lit(True))
    _log_others(spark, files.where(broken).withColumn("status", F.lit("failed")).withColumn("reason", F.lit("unreadable")), lake_root, load)
    good, bad = files.where(~foreign & ~broken), []
    left = {r["src_file"] for r in good.select("src_file").collect()}  # of one pass
    while left:
        try:
            _land_files(spark, good.where(~F.col("src_file").isin(bad)) if bad else good, left, lake_root, folder, mode, fmt, load, known)
            break
        except Exception as e:  # noqa: BLE001 - the file that the error names is logged as failed; without one, all are
            named = _unreadable(str(e), left)
            said = re.search(r"\[[A-Z_.]+\] [^\n]*|unreadable entry [^\n]*", str(e))
            why = (said.group(0) if said else str(e).split("\n")[0])[:300]
            failed = [named] if named else sorted(left)
            _log_others(spark, good.where(F.col("src_file").isin(failed)).withColumn("status", F.lit("failed")).withColumn("reason", F.lit(why)), lake_root, load)
            bad += failed
            left -= set(failed)


def _unreadable(message: str, paths: set[str]) -> str | None:
    """The one of ``paths`` that Spark's error names as the file it couldn't read."""
    for named in re.findall(r"(?:reading file|unreadable entry) (\S+?)\.?(?:\s|$)", message):
        plain = re.sub(r"^file:/+", "file:/", unquote(named))
        if plain in paths:
            return plain
    return None


def _land_files(spark: SparkSession, files: DataFrame, paths: set[str], lake_root: str, folder: str, mode: str, fmt: str, load: str, known: list[str]) -> None:
    layouts = csvlake.layouts_of(files.withColumnRenamed("src_file", "file_path"))
    columns = csvlake.united(layouts, known)
    held = files.where("columns IS NOT NULL")
    parts = []
    plain = sorted(p for p in paths if not archives.is_entry(p))
    entries = sorted(p for p in paths if archives.is_entry(p))
    if layouts and plain:
        parts.append(csvlake.read_files(spark, plain, held, layouts, columns, ["report_date"]))
    if layouts and entries:
        parts.append(archives.entry_rows(spark, archives.archive_paths(entries), held, layouts, columns, ["report_date"]))
    rows = parts[0] if parts else spark.createDataFrame([], T.StructType([*[T.StructField(c, T.StringType()) for c in [*columns, "src_file"]], T.StructField("report_date", T.DateType())]))
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # by dates: a task of many small files would write a file for each of its dates
    rows = rows.hint("rebalance", F.col("report_date"))
    land(spark, rows, lake_root, folder, "replace", fmt, f"{load}-{uuid.uuid4().hex[:8]}", files.select("src_file", "file_name", "report_date", "bytes", "modified_at", "file_key"))
