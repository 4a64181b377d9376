"""Table lifecycle queries: publish lake folders as tables and query them with plain SQL.

Each call works in a fresh database, so catalog state never leaks between runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.operators import tables as T
from reportlake.plans.fixtures import lake_columns, report_lake, report_store, write_report_lake
from reportlake.plans.registry import register
from reportlake.session import shared_dir


def _fresh_db(spark: SparkSession) -> str:
    db = f"rl_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db}")
    return db


@register(
    "create_table",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_rows,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
       FROM orders GROUP BY 1""",
)
def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External table + typed view over a mixed-layout lake, then plain SQL on it."""
    db = _fresh_db(spark)
    name = f"{db}.orders"
    if not T.create_table(spark, name, report_lake(spark, sf_dir, "orders"), scope="all_rows"):
        raise RuntimeError("table was not created")
    assert T.table_exists(spark, name)
    return spark.sql(
        f"""SELECT report_date, count(*) AS n_rows, CAST(sum(CAST(total_price__usd AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
                   count_if(is_urgent) AS n_urgent
            FROM {name} GROUP BY report_date"""
    )


COUNTS_SQL = """SELECT 'lineitem' AS table_name, TRUE AS ok, count(*) AS n_rows FROM lineitem
                UNION ALL SELECT 'orders_v1_0', TRUE, count(*) FROM orders"""


def _publish(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    db = _fresh_db(spark)
    res = T.publish_missing(spark, report_store(spark, sf_dir), database=db, scope="all_rows")
    return db, res


def _with_counts(spark: SparkSession, db: str, res: DataFrame) -> DataFrame:
    out = None
    for r in res.collect():  # one row per published table
        n = spark.sql(f"SELECT count(*) AS n_rows FROM {db}.{r['table_name']}").select(
            F.lit(r["table_name"]).alias("table_name"), F.lit(r["ok"]).alias("ok"), "n_rows"
        )
        out = n if out is None else out.unionByName(n)
    return out


@register("publish_missing", COUNTS_SQL)
def publish_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored folder without a table gets one; then each is counted with SQL."""
    db, res = _publish(spark, sf_dir)
    return _with_counts(spark, db, res)


@register("republish", COUNTS_SQL)
def republish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recreate published tables with a fresh schema (infer first, then swap) and count them."""
    db, res = _publish(spark, sf_dir)
    names = [r["table_name"] for r in res.collect()]
    again = T.republish(spark, names, database=db, scope="all_rows")
    return _with_counts(spark, db, again)


@register(
    "republish_keeps_readers",
    """SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date, count(*) AS n_before, count(*) AS n_after,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_before, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_after,
              '1,2' AS generations
       FROM orders GROUP BY 1""",
)
def republish_keeps_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A republished table is looked up, republished again, and read by both the old lookup and a new one;
    the generations that are left: the one read now and the one before (T6)."""
    db, _ = _publish(spark, sf_dir)
    name = f"{db}.orders_v1_0"

    def totals(table: DataFrame, which: str) -> DataFrame:
        price = F.sum(F.col("total_price__usd").cast("decimal(18,2)")).cast("double")
        return table.groupBy("report_date").agg(F.count("*").alias(f"n_{which}"), price.alias(f"sum_{which}"))

    def again() -> None:
        if not T.republish(spark, ["orders_v1_0"], database=db).first()["ok"]:
            raise RuntimeError("table was not republished")

    again()
    before = totals(spark.table(name), "before")
    again()
    left = sorted(t.name.rsplit("_", 1)[1] for t in spark.catalog.listTables(db) if t.name.startswith(f"orders_v1_0{T.RAW_SUFFIX}"))
    return before.join(totals(spark.table(name), "after"), "report_date", "full_outer").withColumn("generations", F.lit(",".join(left)))


@register(
    "publish_collisions",
    """SELECT * FROM (SELECT 'east/orders-late' AS folder, 'orders_late' AS table_name, TRUE AS ok, '' AS collides_with, count(*) AS n_rows FROM orders WHERE o_orderkey % 3 = 2
       UNION ALL SELECT 'north/orders_v1-0', 'orders_v1_0', FALSE, 'south/orders_v1-0', NULL
       UNION ALL SELECT 'south/orders_v1-0', 'orders_v1_0', FALSE, 'north/orders_v1-0', NULL
       UNION ALL SELECT 'west/orders.late', 'orders_late', FALSE, 'east/orders-late', NULL)""",
)
def publish_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that propose one table name, at once or after a table has it: reported, not published (T5, Q16)."""
    root, db = shared_dir(spark, "collisions"), _fresh_db(spark)
    date_col, cols = lake_columns("orders")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    part = lambda k, folder: write_report_lake(orders.where(F.col("o_orderkey") % 3 == k), date_col, cols, f"{root}/{folder}")
    for k, folder in enumerate(("north/orders_v1-0", "south/orders_v1-0", "east/orders-late")):
        part(k, folder)
    T.publish_missing(spark, root, database=db)
    first = T.list_tables(spark, db).select("table_name", "location")
    part(0, "west/orders.late")
    again = T.publish_missing(spark, root, database=db)
    within = lambda c: F.regexp_extract(c, r"([^/]+/[^/]+)$", 1)
    held = first.select(within(F.col("location")).alias("folder"), "table_name", F.lit(True).alias("ok"), F.lit("").alias("collides_with"))
    out = held.unionByName(again.select(within(F.col("folder")).alias("folder"), "table_name", "ok", within(F.col("error")).alias("collides_with")))
    counted = spark.table(f"{db}.orders_late").agg(F.count("*").alias("n_rows")).withColumn("ok", F.lit(True))
    return out.join(counted, "ok", "left").select("folder", "table_name", "ok", "collides_with", "n_rows")


@register(
    "list_tables",
    """SELECT * FROM (VALUES ('orders_v1_0', TRUE, 'report_date', CAST(9 AS INTEGER)), ('lineitem', TRUE, 'report_date', CAST(%d AS INTEGER)))
       AS t(table_name, is_partitioned, partition_columns, n_columns)"""
    % (len(lake_columns("lineitem")[1]) + 1),
)
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published tables with partitioning and column count; location and time differ in every run."""
    db, _ = _publish(spark, sf_dir)
    return T.list_tables(spark, db).select("table_name", "is_partitioned", "partition_columns", "n_columns")


@register(
    "drop_plan",
    """SELECT * FROM (VALUES ('orders_v1_0', 'would_drop', TRUE), ('lineitem', 'dropped', FALSE)) AS t(table_name, action, exists_after)""",
)
def drop_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry-run drop of one table and a real drop of another, and whether each is there after."""
    db, _ = _publish(spark, sf_dir)
    dry = T.drop_tables(spark, ["orders_v1_0"], database=db, dry_run=True)
    real = T.drop_tables(spark, ["lineitem"], database=db, dry_run=False)
    rows = [(r["table_name"], r["action"], T.table_exists(spark, f"{db}.{r['table_name']}")) for r in dry.collect() + real.collect()]
    return spark.createDataFrame(rows, "table_name string, action string, exists_after boolean")
