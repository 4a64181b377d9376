"""Loads of many small files: listed, read, counted and written in few tasks and files."""

from pyspark.sql import functions as F

from reportlake.operators import catalog as C
from reportlake.operators import infer
from reportlake.operators import load as L
from reportlake.plans.fixtures import LANDING_SPEC, write_named_gzip
from reportlake.session import shared_dir
from reportlake.sources import csvlake
from reportlake.streaming import ingest


def test_many_files_take_few_tasks_and_land_in_few_files(spark):
    root, lake = shared_dir(spark, "small-files"), shared_dir(spark, "small-lake")
    n = 80 * spark.sparkContext.defaultParallelism
    names = [(f"ledger__1995{k % 12 + 1:02d}__o{k}__d1.csv.gz", f"key,price\n{k},1.00\n") for k in range(n)]
    write_named_gzip(spark.createDataFrame(names, "name string, content string").repartition(8), root)
    catalog = C.build_catalog(C.list_files(spark, root), [LANDING_SPEC])
    spark.sparkContext.setJobGroup("small-files", "")
    try:
        L.upload(spark, catalog, lake)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("small-files") for s in status.getJobInfo(j).stageIds]
    tasks = [s.numTasks for s in stages if s is not None]
    assert tasks and max(tasks) <= csvlake.SHARES_PER_CORE * spark.sparkContext.defaultParallelism < n
    folder = f"{lake}/{LANDING_SPEC.storage_folder_name}"
    landed = L.committed(spark, L.read_landed(spark, folder), lake)
    assert landed.count() == n and landed.select("src_file").distinct().count() == n
    assert len(L.read_landed(spark, folder).inputFiles()) <= 2 * 12
    assert {r["status"] for r in L.verify(spark, lake, LANDING_SPEC.storage_folder_name).collect()} == {"ok"}
    assert spark.conf.get(csvlake.LISTING_TASKS) == "10000"


def test_a_batch_of_a_stream_lists_its_files_in_few_tasks(spark):
    root, lake = shared_dir(spark, "stream-files"), shared_dir(spark, "stream-lake")
    n = 12 * spark.sparkContext.defaultParallelism
    names = [(f"ledger__199501__o{k}__d1.csv.gz", f"key,price\n{k},1.00\n") for k in range(n)]
    write_named_gzip(spark.createDataFrame(names, "name string, content string").repartition(8), root)
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("before-stream", "")
    spark.range(1).count()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    job = max(status.getJobIdsForGroup("before-stream")) + 1
    ingest.run_uploads(spark, root, [LANDING_SPEC], lake, shared_dir(spark, "stream-checkpoint"))
    tasks = []
    while info := status.getJobInfo(job):
        tasks += [s.numTasks for s in map(status.getStageInfo, info.stageIds) if s is not None]
        job += 1
    assert len(tasks) > 10 and max(tasks) <= csvlake.SHARES_PER_CORE * spark.sparkContext.defaultParallelism < n
    assert L.read_log(spark, lake).where("status = 'ok'").count() == n


def test_profile_of_groups_on_batches_equals_the_aggregate(spark):
    cells = [None, "", " none ", "1", "00123", "-7", "yes", "1.5", "nan", "2020-01-01", "2020-01-01 10:11:12", "x y", "9223372036854775808"]
    big = F.when(F.col("id") % 2 == 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-(1 << 63)))
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("f"), F.col("id") % 7)).alias("f"), F.when(F.col("id") % 3 > 0, F.expr("date_add(date'2020-01-31', int(id % 3))")).alias("d"),
        F.element_at(F.array(*[F.lit(c) for c in cells]), (F.col("id") % len(cells) + 1).cast("int")).alias("v"), F.col("id").cast("string").alias("w"), big.alias("s"), (F.col("id") - 1500).cast("int").alias("t")).repartition(5)
    got = infer.profile_by(df, ["v", "w"], ["f", "d"], ["s", "t"])
    counts = infer.profile(df, ["v", "w"], by=["f", "d"])
    total = df.groupBy("f", "d").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("s", "t")])
    wanted = counts.join(total, counts["f"].eqNullSafe(total["f"]) & counts["d"].eqNullSafe(total["d"])).select(*[counts[c] for c in counts.columns], "rows", "s", "t")
    names = wanted.columns
    assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, wanted.collect())) and got.count() > 20
    assert infer.profile_by(df.where(F.lit(False)), ["v"], ["f"], ["s"]).count() == 0
