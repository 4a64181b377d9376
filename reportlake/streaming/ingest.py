"""Incremental ingest (R1): each run takes only the files that no run has seen before.

A stream over a folder's file names (the contents aren't read by it) gives each micro-batch the files
that arrived; its checkpoint remembers them by path. The batch itself is an ordinary batch job over
those files, by their own headers, so nothing is read by position and files that don't fit aren't lost:

- ``run_uploads`` hands the arrivals to ``load.upload``: every file ends in the load log under one
  status, and rows are shown by ``load.committed``. A batch is known by its stream and number, so a batch
  that is run again after a crash lands only what it had not committed.
- ``run_once`` writes typed rows as Parquet under the batch's number; a batch that is run again
  overwrites its own rows. Cells that don't convert are named in ``_rejected``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reportlake.functions import names as N
from reportlake.operators import catalog as C
from reportlake.operators import load as L
from reportlake.operators.infer import InferredSchema
from reportlake.session import shared_dir
from reportlake.sources import csvlake
from reportlake.sources.specs import SourceSpec

FILES_PER_BATCH = 1000


def arrivals(spark: SparkSession, root: str, glob: str = "*", max_files_per_trigger: int = FILES_PER_BATCH, recursive: bool = True) -> DataFrame:
    """Streaming file names under a root: path, length, modificationTime."""
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files_per_trigger)
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = reader.schema(schema).option("recursiveFileLookup", str(recursive).lower()).load(root)
    return files.select("path", "length", "modificationTime")


def _run(files: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    with csvlake.listed_in_shares(files.sparkSession):  # the source lists each batch by the settings of this session
        query = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def upload_batch(files: DataFrame, number: int, specs: list[SourceSpec], lake_root: str, stream: str, **options) -> None:
    """One batch of arrivals into the lake and its log, once: files that an earlier run of the same
    batch has logged are left out."""
    spark = files.sparkSession
    load = f"{stream}-{number:09d}"
    log = L.read_log(spark, lake_root)
    listing = files.withColumn("src_file", csvlake.plain_path(F.col("path")))
    if log is not None:
        done = log.where(F.col("load_id").startswith(load)).select("src_file").distinct()
        listing = listing.join(done, "src_file", "left_anti")
    kept = shared_dir(spark, "stream-batch")
    listing.select("path", "length", "modificationTime").write.parquet(kept)
    listing = spark.read.parquet(kept)
    if listing.head(1):
        L.upload(spark, C.build_catalog(listing, specs), lake_root, load=load, **options)


def run_uploads(spark: SparkSession, root: str, specs: list[SourceSpec], lake_root: str, checkpoint: str, stream: str = "stream", max_files_per_trigger: int = L.FILES_PER_PASS, **options) -> None:
    """Load every file under ``root`` that isn't in the checkpoint yet, then stop (``options``: of ``load.upload``).

    A batch takes what one pass of ``upload`` does: every batch costs some dozens of jobs whatever its size, so
    small ones make the time grow with their number. ``stream`` names the load ids; a checkpoint and a name belong together."""
    _run(
        arrivals(spark, root, max_files_per_trigger=max_files_per_trigger),
        lambda files, number: upload_batch(files, number, specs, lake_root, stream, **options),
        checkpoint,
    )


def run_once(spark: SparkSession, root: str, schema: InferredSchema, sink: str, checkpoint: str, max_files_per_trigger: int = FILES_PER_BATCH) -> int:
    """Process every file of a lake folder not yet in the checkpoint, then stop; returns the rows of this run.

    Columns are those of ``schema``; a column that only later files have waits for the next inference."""
    rows = 0

    def batch(files: DataFrame, number: int) -> None:
        nonlocal rows
        paths = [r["p"] for r in files.select(csvlake.plain_path(F.col("path")).alias("p")).collect()]  # FILES_PER_BATCH at most
        heads = csvlake.file_heads(spark, None, paths=paths) if paths else None
        layouts = csvlake.layouts_of(heads) if paths else ()
        if not layouts:
            return
        held = heads.where("columns IS NOT NULL").withColumnRenamed("file_path", "src_file")
        raw = csvlake.read_files(spark, paths, held, layouts, schema.columns)
        date = F.to_date(F.regexp_extract("src_file", f"/{N.PARTITION_KEY}=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/", 1))
        typed = csvlake.apply_types(raw, schema.columns, schema.types, "quarantine").withColumn(N.PARTITION_KEY, date)
        out = typed.withColumn("batch", F.lit(number))
        seen = Observation()
        out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(N.PARTITION_KEY, "batch").parquet(sink)
        rows += seen.get["n"]

    _run(arrivals(spark, root, csvlake.GZ_GLOB, max_files_per_trigger), batch, checkpoint)
    return rows
