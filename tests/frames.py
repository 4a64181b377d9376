"""Small frames for tests (a module of its own: every folder of tests has a ``conftest``)."""


def one_col(spark, values, name="v", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
