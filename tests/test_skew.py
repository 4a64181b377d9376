"""A third of all rows on one key: results stay whole and exact, and the heavy key is
pre-aggregated before any shuffle (partial aggregation / partial window limit)."""

from pyspark.sql import functions as F

from reportlake.operators import catalog as C
from reportlake.operators import infer


def test_hot_name_and_hot_folder(spark):
    n = 30_000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot.csv.gz")).otherwise(F.concat(F.lit("f"), F.col("id").cast("string"), F.lit(".csv.gz"))).alias("file_name"),
        F.when(F.col("id") % 3 == 0, F.lit("store/hot")).otherwise(F.concat(F.lit("store/t"), (F.col("id") % 50).cast("string"))).alias("folder"),
        F.lit("b").alias("base_name"),
        F.lit("").alias("file_version"),
        F.lit("s").alias("source_id"),
    ).repartition(16)
    dups = C.duplicate_files(base)
    assert dups.count() == n // 3
    assert "partial_count" in dups._jdf.queryExecution().executedPlan().toString()

    stored = base.select(F.concat(F.col("folder"), F.lit("/report_date=2024-01-31/"), F.monotonically_increasing_id().cast("string"), F.lit(".csv.gz")).alias("path"))
    fs = {r["storage_folder_name"]: r for r in C.folder_summary(stored).collect()}
    assert fs["store/hot"]["file_count"] == n // 3
    assert len(fs["store/hot"]["sample_files"].split(",")) == 3
    assert sum(r["file_count"] for r in fs.values()) == n


def test_profile_with_hot_value_is_exact(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("v")
    ).repartition(16)
    row = infer.profile(df, ["v"]).first()
    assert row["n_non_null"] == n and row["n_int64"] == n - n // 3
