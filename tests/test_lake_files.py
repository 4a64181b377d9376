"""The files of a report lake: heads once a file, rows whole, and only keys in Python."""

import glob
import gzip

from pyspark.sql import functions as F

from reportlake.plans import fixtures as X
from reportlake.session import shared_dir


def test_two_places_as_printf(spark):
    df = spark.createDataFrame([(v,) for v in (0.005, 0.015, 1.005, 2.675, 0.125, 1e-9, 0.0, -0.0, -0.001, -2.675, 1e15 + 0.3, 1e17, 3e20, 123456.785, 99.995, float("nan"), None)], "v double")
    assert df.where(~X._fmt2(F.col("v")).eqNullSafe(F.format_string("%.2f", "v"))).collect() == []
    many = spark.range(50000).select((F.rand(7) * F.pow(F.lit(10.0), F.col("id") % 9)).alias("v"), (F.col("id") / 200.0).alias("w"))
    assert many.where((X._fmt2(F.col("v")) != F.format_string("%.2f", "v")) | (X._fmt2(F.col("w")) != F.format_string("%.2f", "w"))).count() == 0


def test_lake_files_start_with_their_heads(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/orders.parquet")
    date_col, cols = X.lake_columns("orders")
    root = X.write_report_lake(df, date_col, cols, shared_dir(spark, "heads-test"))
    header, rows = ",".join(c.header for c in cols), 0
    for f in glob.glob(f"{root.removeprefix('file:')}/*/*.csv.gz"):
        lines = gzip.open(f, "rt").read().split("\n")[:-1]
        titled = int(f.split("report_date=")[1][5:7]) % 2 == 0
        assert lines[: 1 + titled] == ([X.TITLE] if titled else []) + [header]
        assert header not in lines[1 + titled :] and X.TITLE not in lines[1 + titled :]
        rows += len(lines) - 1 - titled
    assert rows == df.count()


def test_only_keys_go_to_python(spark):
    flagged = spark.range(0, 30, 1, 1).select((F.col("id") % 3).cast("string").alias("k"), "id").withColumn("is_first", X._first_of_key("k"))
    assert sorted(r["id"] for r in flagged.collect() if r["is_first"]) == [0, 1, 2]
