"""Classes counted on Arrow batches against the Column expressions, and the plan of a whole profile."""

import pyarrow as pa
from pyspark.sql import functions as F

from reportlake.functions import values as V
from reportlake.operators import infer

CELLS = [
    None, "", "null", " NULL ", "None", "1", "0", "+1", "-007", "007", "00123", "-0", "+0", "9223372036854775807", "9223372036854775808",
    "-9223372036854775808", "-9223372036854775809", "000000000000000000000000000001", "+00000000000000000000000000000001", "1.5", ".5", "5.", "1e5", "1E-5", "1.e5", "1e", "e5",
    "inf", "-Infinity", "NaN", "ınf", "İnf", "yes", "No", "TRUE", "faLse", "x", "-", "+", ".", "--1", "1,000", "0x10", "１２", "٣", "a\nb", "1\n2", "1\x00",
    " \t5\x0b\f", "1\u0085", "1.5\u0085", "1.5 ", "1.5\r\n", "2020-01-01", "2020/01/01", "2020-01/01", "2020-01-01 ", "2020-01-01 10:11:12", "2020/01/01 10:11:12.123", "2020-01-01T10:11:12",
]


def test_class_counts_agree_with_the_columns(spark):
    df = spark.createDataFrame([(v,) for v in CELLS], "v string")
    for leading_zero in ("decimal", "string"):
        for r in df.select("v", V.class_code(V.null_if_token("v"), leading_zero).alias("k")).collect():
            wanted = [0 if r["k"] is None or r["k"] != code else 1 for code in range(len(V.CLASS_NAMES))]
            assert V.class_counts(pa.array([r["v"]], pa.string()), leading_zero).tolist() == wanted, repr(r["v"])


def test_whole_profile_counts_on_batches_and_equals_the_grouped_one(spark):
    df = spark.createDataFrame([(v, "x" if v else None, 1) for v in CELLS * 3], "v string, w string, g int").repartition(5)
    whole = infer.profile(df, ["v", "w"])
    assert "MapInArrow" in whole._jdf.queryExecution().executedPlan().toString()
    grouped = infer.profile(df, ["v", "w"], by=["g"]).drop("g")
    assert sorted(whole.collect()) == sorted(grouped.collect())
    assert [tuple(r) for r in infer.profile(df.where(F.lit(False)), ["v"]).collect()] == [("v", 0, 0, 0, 0, 0, 0, 0)]


def test_profile_of_text_that_is_no_utf8(spark):
    df = spark.sql("SELECT cast(x AS string) AS v FROM VALUES (X'31FF'), (X'31'), (X'FF') AS t(x)")
    assert tuple(infer.profile(df, ["v"]).first()) == ("v", 0, 3, 1, 0, 0, 0, 0)
