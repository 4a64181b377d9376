"""Connected components of a link table, in rounds of large-star and small-star steps.

Each step is a grouped minimum joined back to the links, so no vertex's links are gathered in one
place; each round is written to the shared folder. The number of rounds grows with the logarithm
of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.shared import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition("u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    links = links.repartition("u")
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(u, label) of every vertex that isn't the least of its component; ``links``: (a, b)."""
    now = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = written(now, name)
    before = _state(now)
    while before[0]:
        now = written(_small_star(_large_star(now)), name)
        after = _state(now)
        if after == before:
            break
        before = after
    return now.withColumnRenamed("v", "label")


def forest_roots(parents: DataFrame, name: str = "roots") -> DataFrame:
    """(u, label) of a forest: ``parents`` has one row (u, parent) for each vertex but the roots.
    Every round doubles the length of the steps."""
    now = written(parents.select("u", F.col("parent").alias("label")), name)
    while True:
        up = now.select(F.col("u").alias("label"), F.col("label").alias("above"))
        stepped = now.join(up, "label", "left")
        after = written(stepped.select("u", F.coalesce("above", "label").alias("label"), F.col("above").isNotNull().alias("moved")), name)
        if not after.where("moved").head(1):
            return after.select("u", "label")
        now = after.select("u", "label")
