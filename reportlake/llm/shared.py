"""Written tables in the shared folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.session import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder and read again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column, parts: int) -> Column:
    """A number below ``parts`` for each key: crc32 of it as text."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(parts))
