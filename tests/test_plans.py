"""Plan shape checks: the physical plans we want at scale (no needless shuffles, pruning,
pushed filters, bounded top-k before the shuffle, no Python in the data plane)."""

from pyspark.sql import functions as F

from reportlake.operators import catalog as C
from reportlake.operators import infer
from reportlake.operators import tables as T
from reportlake.plans.fixtures import FIXTURE_SPECS, landing_listing, report_lake, store_listing


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


PY = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def test_catalog_build_is_one_narrow_stage(spark, sf_small):
    cat = C.build_catalog(landing_listing(spark, sf_small), FIXTURE_SPECS)
    p = plan(cat)
    # the only exchange allowed is spread()'s round robin over the single-split input
    assert "hashpartitioning" not in p and "rangepartitioning" not in p and "Join" not in p
    assert not any(x in p for x in PY)
    assert "Generate explode" in p


def test_profile_is_one_pass_with_single_small_shuffle(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    cols = ["l_orderkey", "l_quantity", "l_returnflag"]
    prof = infer.profile(li.select(*[F.col(c).cast("string").alias(c) for c in cols]), cols)
    p = plan(prof)
    assert p.count("Exchange") == 1 and "SinglePartition" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in p


def test_folder_summary_limits_samples_before_shuffle(spark, sf_small):
    fs = C.folder_summary(store_listing(spark, sf_small))
    fs.collect()
    opt = optimized(fs)
    assert "WindowGroupLimit" in opt


def test_duplicates_aggregate_partially(spark, sf_small):
    cat = C.accepted(C.build_catalog(landing_listing(spark, sf_small), FIXTURE_SPECS))
    p = plan(C.duplicate_files(cat))
    assert "partial_count" in p


def test_lake_scan_prunes_partitions_and_columns(spark, sf_small):
    from reportlake.sources import csvlake

    root = report_lake(spark, sf_small, "orders")
    head = csvlake.lake_head(spark, root)
    raw = csvlake.read_raw(spark, root, head, with_source=False)
    q = raw.where(F.col("report_date") == F.lit("1996-06-30").cast("date")).select("order_key")
    p = plan(q)
    assert "PartitionFilters: [isnotnull(report_date" in p
    assert "report_date=1996-06-30" in p or "1 paths" in p or "PartitionCount: 1" in p
    # titled files: only a hash of the path goes to Python, to number the rows of each file
    assert "_place_in_run(xxhash64(" in p and "MapIn" not in p
    read = p[p.index("ReadSchema"):].split("\n")[0]
    assert "_c0" in read and "_c1" not in read


def test_filters_on_cells_stay_above_the_numbering(spark, tmp_path):
    """A filter on a column must not run before the header under a title is found by its place."""
    import gzip

    from reportlake.sources import csvlake

    day = tmp_path / "numbered" / "report_date=2020-01-31"
    day.mkdir(parents=True)
    (day / "a.csv.gz").write_bytes(gzip.compress(b"Title\nk,v\n1,x\nk,v\n2,y\n"))
    (day / "b.csv.gz").write_bytes(gzip.compress(b"k,v\nk,v\n3,z\n"))
    root = str(tmp_path / "numbered")
    raw = csvlake.read_raw(spark, root, csvlake.lake_head(spark, root), with_source=False)
    assert sorted(tuple(r)[:2] for r in raw.collect()) == [("1", "x"), ("2", "y"), ("3", "z"), ("k", "v"), ("k", "v")]
    assert raw.where("k = 'k'").count() == 2 and raw.where("v = 'y'").count() == 1
    assert raw.where("report_date = DATE'2020-01-31' AND k <> 'k'").count() == 3


def test_table_view_keeps_partition_pruning(spark, sf_small):
    spark.sql("CREATE DATABASE IF NOT EXISTS plan_db")
    name = "plan_db.orders_plan"
    if not spark.catalog.tableExists(name):
        T.create_table(spark, name, report_lake(spark, sf_small, "orders"), scope="all_rows")
    q = spark.sql(f"SELECT count(*) FROM {name} WHERE report_date = DATE'1996-06-30'")
    p = plan(q)
    assert "PartitionFilters" in p and "report_date#" in p
    assert q.first()[0] > 0


def test_new_files_is_anti_join(spark, sf_small):
    cat = C.accepted(C.build_catalog(landing_listing(spark, sf_small), FIXTURE_SPECS))
    st = C.match_stored(store_listing(spark, sf_small), FIXTURE_SPECS)
    p = plan(C.new_files(cat, st))
    assert "LeftAnti" in p


def test_new_path_list_and_recent_file_filters_reach_the_scan(spark, tmp_path):
    import datetime as dt
    import gzip

    from reportlake.sources import csvlake

    for i in range(3):
        p = tmp_path / "l" / f"f{i}.csv.gz"
        p.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(p, "wt") as f:
            f.write("a,b\n1,2\n")
    root = str(tmp_path / "l")
    head = csvlake.lake_head(spark, root)
    rows = csvlake.read_raw(spark, root, head, recursive=True)
    keep = [r["src_file"] for r in rows.select("src_file").distinct().collect()][:1]
    q = rows.where(F.col("src_file").isin(keep))
    assert q.count() == 1
    scan = [line for line in plan(q).split("\n") if "FileScan" in line][0]
    assert "file_path" in scan and "DataFilters" in scan
    since = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=5)
    recent = spark.read.option("header", "true").csv(root).where(
        F.col("_metadata.file_modification_time") >= F.lit(since))
    assert recent.count() == 0
    assert "file_modification_time" in [line for line in plan(recent).split("\n") if "FileScan" in line][0]
